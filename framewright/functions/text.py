"""Caption text as Catalyst expressions: auditing, cleaning, sanitising, leads.

Patterns run with the flags ``(?iU)``, so case and word limits follow Unicode.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words, phrases and limits of the caption standard.
FRAMINGS = ("close-up shot", "waist-up shot", "full-body shot", "portrait shot")
HAND_WORDS = ("hand", "hands", "finger", "fingers", "out of frame", "wrists", "arms")
CLASS_NOUNS = ("woman", "man", "person", "girl", "boy", "model")
SHOTS = {"close-up": "close-up", "medium": "waist-up", "full-body": "full-body"}
BANNED = (
    (r"\b(?:that|which|to)?\s*(?:accentuates?|highlights?|flatter(?:s|ing)?)\s+(?:her|his|their|the)\s+(?:figure|physique|curves|body|frame)\b", "accentuates figure/physique"),
    (r"\badd(?:ing|s)?\s+a\s+sense\s+of\b", "adding a sense of"),
    (r"\bfocus(?:ing|es)?\s+the\s+viewer(?:'s)?\s+attention(?:\s+on\s+[^.,;]+)?\b", "focusing the viewer attention"),
    (r"\bdraw(?:ing|s)?\s+the\s+viewer(?:'s)?\s+attention(?:\s+on\s+[^.,;]+)?\b", "drawing the viewer attention"),
    (r"\bcentral\s+subject\s+of\s+the\s+image\b", "central subject of the image"),
    (r"\bemphasiz(?:ing|es)\s+(?:her|his|their)\s+presence(?:\s+in\s+the\s+frame)?\b", "emphasizing presence in the frame"),
    (r"\ba\s+sense\s+of\s+mystery\b", "a sense of mystery"),
    (r"\bis\s+captured\s+in\b", "is captured in"),
    (r"\bis\s+the\s+subject\s+of\s+this\b", "is the subject of this"),
    (r"\b(?:photorealistic|hyperrealistic|masterpiece|8k|uhd)\b", "quality buzzword (photorealistic/masterpiece)"),
    (r"\b(?:dramatic|cinematic)\s+lighting\b", "subjective lighting buzzword (dramatic/cinematic lighting)"),
)
SANITIZE = (
    (r",?\s*(?:that|which|to)?\s*(?:accentuates?|highlights?|flatter(?:s|ing)?)\s+(?:her|his|their|the)\s+(?:figure|physique|curves|body|frame)", ""),
    (r",?\s*add(?:ing|s)?\s+a\s+sense\s+of\s+[^.,;]+(?:\s+to\s+the\s+image)?", ""),
    (r",?\s*focus(?:ing|es)?\s+the\s+viewer(?:'s)?\s+attention(?:\s+on\s+[^.,;]+)?", ""),
    (r",?\s*draw(?:ing|s)?\s+the\s+viewer(?:'s)?\s+attention(?:\s+on\s+[^.,;]+)?", ""),
    (r",?\s*emphasiz(?:ing|es)\s+(?:her|his|their)\s+presence(?:\s+in\s+the\s+frame)?", ""),
    (r",?\s*(?:emphasiz(?:ing|es)|mak(?:ing|es)|highlight(?:ing|s))?\s*(?:her|him|them|the\s+subject)?\s*(?:as\s+)?(?:the\s+)?central\s+subject(?:\s+of\s+the\s+image)?", ""),
    (r",?\s*(?:and\s+)?putting\s+the\s+focus\s+on\s+her", ""),
    (r"\b(?:photorealistic|hyperrealistic|masterpiece|8k|uhd)\b\s*,?", ""),
    (r"\b(?:dramatic|cinematic)\s+lighting\b", "soft directional lighting"),
)
PREAMBLES = (
    r"^(?:sure|certainly|here is|here\'s|this is|okay|ok)\b[^:\n]*[:\n-]\s*",
    r"^(?:in this image|in the image|in this photo|the image shows|this photo shows)\s*,?\s*",
)
RUBRIC = r"^\*{0,2}(?:framing(?:\s+and\s+camera\s+angle)?|subject\s+pose[^:]*|clothing(?:\s+and\s+accessories)?|setting[^:]*|lighting[^:]*)\*{0,2}\s*:\s*"
INTRO = (
    r"^(?:(?:is|are)\s+)?(?:(?:a|the|this)\s+)?(?:woman|man|person|model|subject|individual)?\s*(?:(?:is|are)\s+)?(?:captured\s+in|seen\s+in|shown\s+in|featured\s+in|the\s+subject\s+of|pictured\s+in)?\s*"
    r"(?:(?:in|of|for|with)\s+)?(?:(?:a|the|this)\s+)?(?:close[- ]up|waist[- ]up|full[- ]body|medium|wide[- ]angle|eye[- ]level|low[- ]angle|high[- ]angle|portrait|photo|picture|shot|image)?\s*"
    r"(?:portrait|photo|shot|picture|image)?\s*(?:of\s+)?(?:(?:a|the)\s+)?(?:woman|man|person|model|subject|individual)?\s*(?:is\s+)?(?:captured|seen|shown|pictured|featured)?\s*"
)
CONTINUATIONS = ("looking", "seated", "sitting", "standing", "lying", "kneeling", "leaning", "posing", "posed", "wearing", "dressed", "with ", "in ", "at ", "from ", "outdoors", "indoors")
#: Turns of the lead-stripping loop in the SQL twins. The expression here goes on until the text is stable.
LOOP_TURNS = 8


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def sub(text: Column, pattern: str | Column, replacement: str, flags: str = "(?iU)") -> Column:
    """All matches replaced; a Column pattern carries its own flags."""
    return F.regexp_replace(text, F.lit(flags + pattern) if isinstance(pattern, str) else pattern, F.lit(replacement))


def strip(text: Column, chars: str = r"\s") -> Column:
    """Without the given characters at both ends (all white space by default)."""
    return F.regexp_replace(text, rf"(?U)^[{chars}]+|[{chars}]+$", "")


def word_count(text: Column) -> Column:
    """Number of pieces between white space; 0 for a blank or null text."""
    return let(strip(text), lambda bare: F.when(F.coalesce(bare, F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split(bare, r"(?U)\s+"))))


def quoted(word: Column) -> Column:
    """The word as a literal inside a pattern, also if it holds the closing quote."""
    return F.concat(F.lit(r"\Q"), F.replace(word, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def usable_trigger(trigger: Column) -> Column:
    return F.coalesce(strip(trigger) != "", F.lit(False))


def trigger_count(text: Column, trigger: Column) -> Column:
    """Whole-word occurrences of the trigger; null without a trigger."""
    return F.when(usable_trigger(trigger), F.regexp_count(text, F.concat(F.lit(r"(?iU)\b"), quoted(trigger), F.lit(r"\b"))))


def ends_sentence(text: Column) -> Column:
    return F.substring(text, -1, 1).isin(".", "!", "?")


def mentions_hands(text: Column) -> Column:
    return any_of(F.lower(text), lambda low: [low.contains(word) for word in HAND_WORDS])


def any_of(value: Column, tests: Callable[[Column], list[Column]]) -> Column:
    """Whether one of the tests of the value holds."""
    return let(value, lambda v: reduce(lambda a, b: a | b, tests(v)))


def audit_violations(caption: Column, trigger: Column) -> Column:
    """Violations of the caption standard in rule order; empty array if it passes.

    A null or blank caption is only "empty". Without a trigger (null or blank) the
    trigger rules are not applied.
    """


    def rules(text: Column, words: Column, low: Column, count: Column) -> Column:
        found = [
            F.when(words < 20, F.format_string("Too short (%d words, minimum 20)", words)).when(words > 95, F.format_string("Too long (%d words, maximum 95)", words)),
            F.when(count == 0, F.format_string("Missing trigger word '%s'", trigger)).when(count > 1, F.format_string("Duplicate trigger word '%s' (%d occurrences)", trigger, count)),
            *[F.when(F.regexp_count(low, F.lit(shot)) > 1, F.lit(f"Duplicate framing phrase '{shot}'")) for shot in FRAMINGS],
            *[F.when(text.rlike("(?iU)" + pattern), F.lit(f"Banned cliché / meta-fluff: '{name}'")) for pattern, name in BANNED],
            F.when(~mentions_hands(text), F.lit("Missing explicit hand placement (state location or 'hands are out of frame')")),
            F.when(~ends_sentence(text), F.lit("Missing terminal punctuation")),
        ]
        return F.when(text == "", F.array(F.lit("Caption is empty"))).otherwise(F.array_compact(F.array(*found)))

    facts = lambda t: F.struct(t.alias("t"), word_count(t).alias("n"), F.lower(t).alias("low"), trigger_count(t, trigger).alias("c"))
    return let(let(strip(F.coalesce(caption, F.lit(""))), facts), lambda f: rules(f["t"], f["n"], f["low"], f["c"]))


def violation_key(violation: Column) -> Column:
    """Violation without its numbers, for counting."""
    return F.trim(F.regexp_replace(violation, r"\(\d+.*?\)", ""))


def sanitized(caption: Column) -> Column:
    """Caption without banned phrases, with a word on the hands and a final stop; null becomes that word alone."""
    text = strip(F.coalesce(caption, F.lit("")))
    for pattern, replacement in SANITIZE:
        text = sub(text, pattern, replacement)
    text = let(text, lambda t: F.when(mentions_hands(t), t).otherwise(F.concat(F.regexp_replace(t, r"[. ]+$", ""), F.lit(". Hands are out of frame."))))
    text = strip(sub(text, r"\s+", " "))
    return with_stop(sub(sub(text, r"\s+([.,;])", "$1"), r",\s*\.", "."))


def with_stop(text: Column) -> Column:
    return let(text, lambda t: F.when(ends_sentence(t), t).otherwise(F.concat(t, F.lit("."))))


def lead(trigger: Column, composition: Column) -> Column:
    """Opening of a caption: the subject with a class noun, and the framing (portrait if unknown)."""
    subject = F.when(F.arrays_overlap(F.split(F.lower(trigger), r"(?U)\s+"), F.array(*map(F.lit, CLASS_NOUNS))), trigger).otherwise(F.concat(trigger, F.lit(" woman")))
    shot = F.lit("portrait")
    for name, phrase in SHOTS.items():
        shot = F.when(composition == name, F.lit(phrase)).otherwise(shot)
    return F.concat(subject, F.lit(", a "), shot, F.lit(" shot"))


def composition_of_caption(caption: Column) -> Column:
    low = F.coalesce(F.lower(caption), F.lit(""))
    return F.when(low.contains("close-up"), "close-up").when(low.contains("full-body"), "full-body").otherwise("medium")


def described(raw: Column) -> Column:
    """Lines of a raw answer without fences, preambles, tags, bullets and headers, as one line ('' if nothing is left)."""
    text = strip(F.coalesce(raw, F.lit("")))
    text = F.regexp_replace(F.regexp_replace(text, "^```[a-zA-Z]*\n?", ""), "\n?```$", "")
    text = strip(F.replace(text, F.lit("`"), F.lit("")), "\"' ")
    for pattern in PREAMBLES:
        text = strip(sub(text, pattern, ""))
    text = F.split(text, r"(?iU)\n\s*tags?\s*:")[0]
    text = sub(text, r"^tags?\s*:.*$", "", "(?imU)")
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: strip(x)), lambda x: (x != "") & ~x.rlike(r"(?iU)^tags?\s*:"))
    lines = F.transform(lines, lambda x: strip(sub(strip(sub(x, r"^[-*•\d.]+\s*", "")), RUBRIC, "")))
    text = strip(F.array_join(F.filter(lines, lambda x: x != ""), " "))
    return sub(sub(text, r"\*{1,2}([^*]+)\*{1,2}", "$1"), r"\s*;\s*", ", ")


def without_lead(text: Column, trigger: Column, opening: Column) -> Column:
    """Body without layered leads, triggers and generic introductions, stray triggers replaced."""
    edge = r" ,.\-"
    repeated = F.concat(F.lit("(?iU)^(?:"), quoted(trigger), F.lit(r"\b\s*(?:woman|man|person|model)?\s*[,:-]?\s*)+"))

    def turn(acc: Column, _: Column) -> Column:
        begun = F.startswith(F.lower(acc), F.lower(opening))
        body = F.when(begun, strip(F.substring(acc, F.length(opening) + 1, F.length(acc)), edge)).otherwise(acc)
        return strip(sub(strip(sub(body, repeated, ""), edge), INTRO, ""), edge)

    def until_stable(acc: Column, step: Column) -> Column:
        return F.when(acc["stable"], acc).otherwise(let(turn(acc["body"], step), lambda b: F.struct(b.alias("body"), b.eqNullSafe(acc["body"]).alias("stable"))))

    # a turn only removes text, so there are at most as many as characters; those after the last change cost nothing
    start = F.struct(text.alias("body"), F.lit(False).alias("stable"))
    body = F.aggregate(F.sequence(F.lit(1), F.length(text) + 1), start, until_stable, lambda acc: acc["body"])
    body = sub(body, F.concat(F.lit(r"(?iU)\b"), quoted(trigger), F.lit(r"\s+(?:woman|man|person|model)\b")), "the subject")
    return sub(body, F.concat(F.lit(r"(?iU)\b"), quoted(trigger), F.lit(r"\b")), "she")


def joined_to_lead(body: Column, opening: Column) -> Column:
    """The body after its lead: as a continuation of it, or as a clause with a small first letter."""

    def join(b: Column) -> Column:
        goes_on = any_of(F.lower(b), lambda low: [low.startswith(start) for start in CONTINUATIONS])
        lowered = F.concat(F.lower(F.substring(b, 1, 1)), F.substring(b, 2, 1_000_000_000))
        return F.when(goes_on, F.concat(opening, F.lit(" "), b)).when(b != "", F.concat(opening, F.lit(", "), lowered)).otherwise(F.concat(opening, F.lit(".")))

    return with_stop(strip(sub(let(body, join), r"\s+", " ")))


def cleaned(raw: Column, trigger: Column, opening: Column) -> Column:
    """struct<ok, text, reason> of a raw answer; the text is '' unless it is accepted."""

    def verdict(line: Column, few: Column, final: Column, many: Column) -> Column:
        reason = (
            F.when(F.coalesce(strip(raw), F.lit("")) == "", "Empty response body")
            .when(line == "", "Empty response after stripping preambles and tags")
            .when(few < 5, F.format_string("Description too short (%d words)", few))
            .when(many < 15, F.format_string("Description too short (%d words)", many))
            .when(many > 130, F.format_string("Description too long (%d words)", many))
            .otherwise("OK")
        )
        return let(reason, lambda r: F.struct((r == "OK").alias("ok"), F.when(r == "OK", final).otherwise("").alias("text"), r.alias("reason")))

    lines = lambda t: F.struct(t.alias("line"), word_count(t).alias("few"), joined_to_lead(without_lead(t, trigger, opening), opening).alias("final"))
    return let(let(described(raw), lines), lambda f: verdict(f["line"], f["few"], f["final"], word_count(f["final"])))


def retry_temperature(attempt: Column) -> Column:
    """Sampling temperature of attempt 0, 1, 2, ..."""
    return F.when(attempt == 0, F.lit(0.2)).otherwise(F.least(F.lit(0.5), F.lit(0.2) + F.lit(0.15) * attempt))


def destination_slug(trigger: Column) -> Column:
    return F.concat(F.lit("flux-"), F.replace(F.lower(trigger), F.lit("_"), F.lit("-")), F.lit("-lora"))


def prompt_notes(hand_status: Column, hands_truncated: Column, year: Column) -> tuple[Column, Column]:
    """Hand and era notes of a prompt; the hand note only where hands are cut at the edge."""
    hand = F.when(hands_truncated & hand_status.isNotNull(), F.concat(F.lit(" (Note: "), hand_status, F.lit(")"))).otherwise("")
    era = F.when(F.coalesce(year, F.lit(0)) != 0, F.concat(F.lit(" Note that the photo was captured in "), year.cast("string"), F.lit("."))).otherwise("")
    return hand, era


def prompt(template: str, opening: Column, hand_note: Column, era_note: Column) -> Column:
    """A caller's template with the slots {lead}, {hand_note} and {era_note} filled."""
    text = F.lit(template)
    for slot, value in (("{lead}", opening), ("{hand_note}", hand_note), ("{era_note}", era_note)):
        text = F.replace(text, F.lit(slot), value)
    return text


def feedback_prompt(base: Column, violations: Column) -> Column:
    """The prompt with the violations of the last attempt appended as a list."""
    listed = F.concat(F.lit("\n\nYour previous caption was rejected for these reasons:\n- "), F.array_join(violations, "\n- "), F.lit("\nWrite a corrected caption."))
    return F.when(F.size(violations) > 0, F.concat(base, listed)).otherwise(base)


def parsed_verdict(response: Column) -> Column:
    """struct<is_single, lighting, has_sunglasses, has_face_occlusion> of a model's answer; null is fail-open."""
    text = F.coalesce(response, F.lit(""))
    eyewear = text.contains("EYEWEAR: SUNGLASSES")
    return F.struct(
        (~text.contains("MULTIPLE_PEOPLE")).alias("is_single"),
        F.when(text.contains("Outdoor"), "Outdoor").otherwise("Indoor").alias("lighting"),
        ((text.contains("SUNGLASSES") & ~text.contains("NO_SUNGLASSES")) | eyewear).alias("has_sunglasses"),
        (text.contains("FACE_OCCLUDED") | eyewear).alias("has_face_occlusion"),
    )
