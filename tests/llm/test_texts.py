"""Tokens, leaked passages, defects and personal information."""

import os
import random
import re

import duckdb
import numpy as np
import pytest

from framewright.llm import common, defects, leakage, personal, tokens

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
tiktoken = pytest.importorskip("tiktoken")
DATA = "/root/testdata/sf0.001"


# ---- tokens ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    if not os.path.exists(RANKS):
        pytest.skip("no vocabulary here")
    return tokens.load_ranks(RANKS)


ODD = ["", " ", "\n\n  a", "<|endoftext|>", "a" * 20000, "é" * 3000, "日本語テキスト" * 50, "don't I'LL we've 123 4567", "​ x y", "👩‍👩‍👧‍👦 ok", "tab\t\tend ", "İstanbul ǅ"]


def test_encoding_equals_the_library(ranks):
    library = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = tokens.Encoder(ranks)
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("ab cdé\n'’1 日") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    names = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        names[rank] = token
    for text in texts:
        ids = encoder.encode(text)
        assert ids == library.encode_ordinary(text) and tokens.decode_ids(ids, names) == text


def test_encoding_of_tables(spark, ranks):
    rows = [(1, "hello world"), (2, None), (3, ""), (None, "x"), (1, "hello world")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "2 as key")
    out = tokens.encode_texts(df, "doc_id", "text", RANKS)
    got = sorted([(r["doc_id"], r["ids"]) for r in out.collect()], key=str)
    assert len(got) == 5 and (2, []) in got and (3, []) in got and got.count((1, tokens.Encoder(ranks).encode("hello world"))) == 2
    back = {(r["doc_id"], r["text"]) for r in tokens.decode_texts(out, "doc_id", "ids", RANKS).collect()}
    assert back == {(1, "hello world"), (2, ""), (3, ""), (None, "x")}
    assert tokens.encode_texts(df.limit(0), "doc_id", "text", RANKS).count() == 0


def test_cache_starts_afresh(ranks, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 3)
    text = "one two three four five six one two"
    assert tokens.Encoder(ranks).encode(text) == tokens.Encoder(ranks).encode(text)


# ---- leakage -----------------------------------------------------------------------------------


def leaks_by_hand(docs, items, run):
    out = set()
    windows = lambda t: {tuple(w[i : i + run]) for w in [leakage.words_of(t)] for i in range(len(w) - run + 1)}
    for d, dt in docs:
        for i, it in items:
            if d is not None and i is not None and windows(dt) & windows(it):
                out.add((d, i))
    return out


@pytest.mark.parametrize(("seed", "bits", "hot"), [(0, 1 << 29, 10**6), (1, 64, 3)])
def test_leaks_against_hand(spark, seed, bits, hot, monkeypatch):
    """Also with a filter that lets almost everything through, and with most keys taken for hot ones."""
    for name in ("MOST_BITS", "LEAST_BITS"):
        monkeypatch.setattr(leakage, name, min(bits, getattr(leakage, name)))
    monkeypatch.setattr(common, "hot_bound", lambda total: hot)
    r = random.Random(seed)
    word = lambda: r.choice("red blue door Lamp, river; stone-wall a the of 12 été".split())
    items = [(i, " ".join(word() for _ in range(r.choice([3, 13, 20, 30])))) for i in range(15)] + [(20, None), (None, "x"), (21, "")]
    docs = []
    for d in range(60):
        body = [word() for _ in range(r.randint(0, 40))]
        source = leakage.words_of(r.choice(items[:15])[1])
        cut = r.choice([8, 12, 13, 14])
        docs.append((d, " ".join(body[:10] + [w.upper() for w in source[:cut]] + body[10:])))
    docs += [(100, None), (101, ""), (None, "x"), (0, docs[0][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "7 as item_id")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "7 as doc_id")
    got = leakage.leaked_items(d, i)
    rows = [tuple(x) for x in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == leaks_by_hand(docs, items, 13)
    report = {x["item_id"]: x["documents"] for x in leakage.leak_report(got, i).collect()}
    assert set(report) == {k for k, _ in items if k is not None} and sum(report.values()) == len(rows)


def test_leaks_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a " * 20)], "item_id long, text string")
    assert leakage.leaked_items(docs, items).count() == 0
    assert leakage.leaked_items(spark.createDataFrame([(1, "a " * 20)], docs.schema), items.limit(0)).count() == 0


# ---- defects -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def attempts():
    if not os.path.isdir("/root/testdata/sf0.01"):
        pytest.skip("no test tables here")
    return duckdb.sql("select distinct attempt_id, base_prompt, content from '/root/testdata/sf0.01/caption_attempts.parquet' order by 1").fetchall()


def test_held_out_accuracy(attempts):
    """Trained on half of the attempts, judged on broken copies of the other half."""
    model = defects.train([(p, c) for k, p, c in attempts if k % 2])
    held = [(p, c) for k, p, c in attempts if not k % 2 and not defects.suspicious(p, c)]
    pairs = [x for x in defects.training_pairs(held, seed=99)]
    right = {k: [0, 0] for k in range(-1, len(defects.LABELS))}
    for p, c, k in pairs:
        got = defects.decide(model, p, c)
        right[k][0] += got == (defects.LABELS[k] if k >= 0 else None)
        right[k][1] += 1
    share = {k: a / max(1, b) for k, (a, b) in right.items()}
    assert all(share[k] >= 0.9 for k in range(len(defects.LABELS))), share
    assert share[-1] >= 0.9, share  # the sound half holds real defects too


@pytest.fixture(scope="module")
def model(attempts):
    return defects.train([(p, c) for _, p, c in attempts])


PROMPT = "Describe the picture in two plain sentences, begin with 'tok woman, a close-up shot' and say where the hands are and where the light comes from."
ANSWER = "tok woman, a close-up shot. She stands near a brick wall and both hands rest in the coat pockets. Lit by soft morning window light from the right with open shadows."


@pytest.mark.parametrize(
    ("content", "defect"),
    [
        (ANSWER, None), (ANSWER + "\n\nTags: parka, tunic", None), (ANSWER.replace("a brick wall", "a sign that reads 'Sorry, we cannot help you today'"), None),
        (None, "empty"), ("", "empty"), (" \n", "empty"), ("```\n```", "empty"), ("**Caption:**", "empty"), ("​", "empty"),
        (PROMPT, "copied_prompt"), (PROMPT + "\n\n" + ANSWER, "copied_prompt"),
        ("I'm sorry, but I can't describe this picture.", "refusal"), ("tok woman, a close-up shot. I must decline this request.", "refusal"),
        ("tok woman, a close-up shot. Das Licht ist warm und die Schatten sind lang. Die Person steht vor einer Mauer und die Hände sind nicht im Bild.", "other_language"),
        (ANSWER[:95], "truncated"), ("tok woman, a close-up shot. Lit by soft morning window light from the", "truncated"),
    ],
)
def test_single_defects(model, content, defect):
    assert defects.decide(model, PROMPT, content) == defect


def test_words_past_the_fortieth_count():
    """A word in the middle of a long text reaches the model."""
    long = lambda word: " ".join(["wall"] * 60 + [word] + ["door"] * 20) + "."
    assert set(defects.pair_features(PROMPT, long("lamp"))[0]) != set(defects.pair_features(PROMPT, long("sign"))[0])


@pytest.mark.parametrize(
    ("content", "rest"),
    [
        (ANSWER + "\n\nTags: parka, tunic", ANSWER), (ANSWER + "\nTags: parka,\ntunic, vest", ANSWER), (ANSWER + "\n\nTags:\nparka\nrain cape\n\nA last line.", ANSWER + " A last line."),
        (ANSWER + "\n\nKeywords: parka, tunic\n\nI cannot go on.", ANSWER + " I cannot go on."), ("\nTags: parka, tunic\n" + ANSWER, ANSWER),
    ],
)
def test_only_the_tag_list_is_left_out(content, rest):
    assert " ".join(defects._TAGS.sub("", content).split()) == rest


@pytest.mark.parametrize("tail", ["I'm sorry, but I can't describe this picture.", "I must decline this request."])
def test_defects_after_a_tag_line(model, tail):
    assert defects.decide(model, PROMPT, "tok woman, a close-up shot.\n\nTags: parka, tunic\n\n" + tail) == "refusal"
    assert defects.decide(model, PROMPT, "tok woman, a close-up shot.\n\nTags: parka, tunic\n\n" + ANSWER) is None


def test_refusals_past_the_fortieth_word(attempts):
    """Trained on half of the attempts; refusals behind long answers of the other half."""
    model, rng = defects.train([(p, c) for k, p, c in attempts if k % 2]), random.Random(5)
    held = [(p, c) for k, p, c in attempts if not k % 2 and p and c and len(c.split()) > 45 and not defects.suspicious(p, c)]
    sound = [(p, c) for p, c in held if defects.decide(model, p, c) is None]
    late = [defects.decide(model, p, c + " " + defects.refused("", rng, unseen=True)) for p, c in sound]
    assert len(late) > 50 and sum(k == "refusal" for k in late) / len(late) > 0.5


# None of these sentences is one that the training can make.
NEW_REFUSALS = [
    "Request denied.", "I'd rather not.", "I do not describe people.", "Describing strangers is something I stay away from.", "My makers do not let me talk about faces.", "I was told to keep away from such photos.", "I shall not be answering that.",
    "You will have to find someone else, as I do not name sitters.", "There is no way I could judge that.", "I have no eyes for attachments.", "I am not the right tool for portraits of persons.", "That kind of question I leave unanswered.", "I don't think I should say anything here.", "I would not feel right writing this.",
    "Sorry, I will stay out of this one.", "I'm declining to caption strangers.", "Unfortunately such pictures are off limits for me.", "Dazu kann ich keine Auskunft geben.", "Je ne souhaite pas en parler.", "No voy a responder a eso.",
]
SOUND_WORDS = [
    "Her left arm cannot be seen fully behind the coat.", "She wears an upload t-shirt with guidelines printed on it.", "A note on the wall says that no help is needed.", "The policy poster behind the man is not sharp.", "He is not able to hide the cup behind the chair.", "A model in a grey coat assists a child with a bag.", "The hat does not cover the ears.", "She refuses the umbrella with a raised hand.",
    "A content creator's badge hangs from the belt.", "The request box on the counter is blocked by a plant.", "The sorry state of the bench is plain to see.", "Nothing is held in the right hand.", "One shoe is not visible below the frame.", "The file cabinet and the access door are painted red.", "The woman declines to sit and leans on the wall.", "A private road sign is not in focus.",
]


def test_refusals_in_words_of_no_list(model):
    found = [defects.decide(model, PROMPT, t) for t in NEW_REFUSALS]
    assert sum(k == "refusal" for k in found) >= 0.9 * len(found), [x for x in zip(NEW_REFUSALS, found) if x[1] != "refusal"]


def test_sound_answers_with_words_of_refusals(model):
    found = [defects.decide(model, PROMPT, ANSWER + " " + t) for t in SOUND_WORDS]
    assert sum(k is None for k in found) >= 0.9 * len(found), [x for x in zip(SOUND_WORDS, found) if x[1]]


def test_without_prompt_only_the_answer_counts(model):
    assert defects.decide(model, None, ANSWER) is None and defects.decide(model, None, "") == "empty"


def test_defects_of_tables(spark, attempts):
    rows = [(k, p, c) for k, p, c in attempts[:400]] + [(9001, PROMPT, None), (9001, PROMPT, None), (9002, None, None), (None, PROMPT, None), (9003, PROMPT, ANSWER + " long" * 50_000 + ".")]
    df = spark.createDataFrame(rows, "attempt_id long, base_prompt string, content string").selectExpr("*", "1 as defect")
    got = [tuple(r) for r in defects.broken_pairs(df).collect()]
    assert len(got) == len({k for k, _ in got}) and {(9001, "empty"), (9002, "empty")} <= set(got) and None not in dict(got)
    assert defects.broken_pairs(df.limit(0)).count() == 0


# ---- personal information ----------------------------------------------------------------------

NAMES = [("Amber", "Vessucci"), ("Jörn", "Pellidale"), ("Olive", "Zorington"), ("Sage", "Haskanvik"), ("Maren", "Drunidale")]


@pytest.fixture(scope="module")
def field():
    weights = personal.train_field(NAMES)
    return personal.Lexicon({g.lower(): "K" for g, _ in NAMES}, {f.lower(): "K" for _, f in NAMES}), weights


def test_held_out_sentences(field):
    """Sentences from another seed, with names that stand on the list or were learned."""
    maker = personal.Sentences(NAMES, 4242)
    finder, hits, wrong, missed = personal.Finder(maker.lexicon()), 0, 0, 0
    for _ in range(600):
        text, gold = maker.document()
        got = {(s.start, s.kind) for s in personal.entities(text, finder, field[1])}
        want = {(a, k) for a, b, k in gold if k or any(personal._repaired(w) in finder.lexicon.family or personal._repaired(w) in finder.lexicon.given for w in re.split(r"[ ,.\-]+", text[a:b]))}
        hits, wrong, missed = hits + len(got & want), wrong + len(got - {(a, k) for a, _, k in gold}), missed + len(want - got)
    assert hits / (hits + wrong) > 0.97 and hits / (hits + missed) > 0.97


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Shot by Amber Vessucci for the set.", [("name", "Amber Vessucci")]),
        ("signed by PELLIDALE, JÖRN on paper", [("name", "PELLIDALE, JÖRN")]),
        ("Ms. Vessucci approved it. Contact O. Zorington now.", [("name", "Vessucci"), ("name", "O. Zorington")]),
        ("Write to amber.vessucci@example.org or call +44 20 7946 0123.", [("email", "amber.vessucci@example.org"), ("phone", "+44 20 7946 0123")]),
        ("Questions go to sage_12 [at] example [dot] com.", [("email", "sage_12 [at] example [dot] com")]),
        ("SSN on the form: 912-33-4567 (blur it).", [("identity_number", "912-33-4567")]),
        ("Return the prints to 12 Maple Street.", [("street_address", "12 Maple Street")]),
        ("Abholung in der Lindenstraße 34.", [("street_address", "Lindenstraße 34")]),
        ("Recogida en Calle Maple 55.", [("street_address", "Calle Maple 55")]),
        ("Retrait au 215 bis, avenue Foxglove.", [("street_address", "215 bis, avenue Foxglove")]),
        ("Amber Ribbon is the name of the backdrop, Sage and Amber gels on the key light.", []),
        ("Camera serial SN-1221-803-0091, see file img_0877@2x.png. Seed 2956019933 gave the cleanest hands at step 003500.", []),
        ("", []),
    ],
)
def test_single_items(field, text, want):
    found = personal.entities(text, personal.Finder(field[0]), field[1])
    assert [(personal.KINDS[s.kind], text[s.start : s.end]) for s in found] == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Shot by Philippa Nguyel for the winter set.", ["Philippa Nguyel"]),
        ("Ms. Nguyel approved frames 3 to 9. Makeup by T. Quarrendon, hair by Amber Vessucci.", ["Nguyel", "T. Quarrendon", "Amber Vessucci"]),
        ("Invoice goes to Kowalind, Aurelio, 12A Hazel Row Rd.", ["Kowalind, Aurelio"]),
        ("Model release signed by PHILIPPA NGUYEL on paper.", ["PHILIPPA NGUYEL"]),
        ("GRADERS LOOK FOR WORN VELVET FIRST, THEN SODIUM GLOW FROM THE QUAY.", []),
        ("Return the prints to 12 Maple Street, Unit 9C. Framed at eye level.", []),
    ],
)
def test_names_on_no_list(field, text, want):
    """The surroundings decide, whatever the corpus has taught."""
    found = personal.entities(text, personal.Finder(field[0]), field[1])
    assert [text[s.start : s.end] for s in found if s.kind == 0] == want


def test_recall_over_all_generated_names(field):
    maker, hits, wrong, total = personal.Sentences(NAMES, 4242), 0, 0, 0
    finder = personal.Finder(personal.Lexicon({g.lower(): "K" for g in maker.given}, {f.lower(): "K" for f in maker.family}))  # nothing is learned
    for _ in range(600):
        text, gold = maker.document()
        got = {s.start for s in personal.entities(text, finder, field[1]) if s.kind == 0}
        want = {a for a, _, k in gold if k == 0 and not text[a:].split()[0].islower()}
        hits, wrong, total = hits + len(got & want), wrong + len(got - {a for a, _, k in gold if k == 0}), total + len(want)
    assert hits / total > 0.95 and wrong / (hits + wrong) < 0.03


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Dr. Marie Curie agreed.", [("name", "Marie Curie")]), ("Mrs. Thatcher called.", [("name", "Thatcher")]), ("We thank Barack Obama", [("name", "Barack Obama")]),
        ("The number is 219-09-9999 here", [("identity_number", "219-09-9999")]), ("the id is 533401234", [("identity_number", "533401234")]),
        ("Meet at 10 Old Saint James Park Road today.", [("street_address", "10 Old Saint James Park Road")]),
        ("Treffen: Am Alten Markt 12.", [("street_address", "Am Alten Markt 12")]),
        ("Write to " + "a.long.part" * 7 + "@example.org now", [("email", "a.long.part" * 7 + "@example.org")]),
    ],
)
def test_items_of_any_length_and_shape(field, text, want):
    found = personal.entities(text, personal.Finder(field[0]), field[1])
    assert [(personal.KINDS[s.kind], text[s.start : s.end]) for s in found] == want
    assert [text.index(w) + 1 for _, w in want] == [s.start + 1 for s in found]


def test_house_number_and_street_without_a_form_of_its_own(field):
    found = personal.entities("She lives at 17 Elm Grove now", personal.Finder(field[0]), field[1])
    assert [(s.kind, s.start) for s in found] == [(4, 13)]


def test_long_list_of_names_is_joined(spark, monkeypatch):
    """A list too long to broadcast gives the same items."""
    texts = ["Shot by Amber Vessucci for the set.", "amber vessucci-drunidale stands near a wall.", None, "", "Ask olive zorington, 12 Elm Street."]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    n = spark.createDataFrame(NAMES, "given_name string, family_name string")
    plain = sorted(tuple(r) for r in personal.find_personal(d, n).collect())
    monkeypatch.setattr(personal, "LEXICON_WORDS", 2)
    assert sorted(tuple(r) for r in personal.find_personal(d, n).collect()) == plain and len(plain) >= 3


def test_name_that_occurs_once(spark):
    d = spark.createDataFrame([(1, "Shot by Philippa Nguyel for the winter set."), (2, "The wall is grey.")], "doc_id long, text string")
    n = spark.createDataFrame(NAMES, "given_name string, family_name string")
    assert [tuple(r) for r in personal.find_personal(d, n).collect()] == [(1, "name", 9)]
    assert personal.redact_personal(d, n).where("doc_id = 1").first()["text"] == "Shot by [NAME] for the winter set."


def test_marginals_and_best_against_enumeration():
    rng = np.random.default_rng(1)
    for _ in range(20):
        spans = {(int(a), int(a + w)) for a, w in zip(rng.integers(0, 12, 7), rng.integers(1, 5, 7))}
        segments = [personal.Segment(a, b, 0, []) for a, b in sorted(spans)]
        scores = list(rng.normal(size=len(segments)) * 2)
        weight, total, best = np.zeros(len(segments)), 0.0, (-1.0, None)
        for mask in range(1 << len(segments)):
            chosen = [k for k in range(len(segments)) if mask >> k & 1]
            if all(segments[a].end <= segments[b].start or segments[b].end <= segments[a].start for a in chosen for b in chosen if a < b):
                score = sum(scores[k] for k in chosen)
                total += np.exp(score)
                weight[chosen] += np.exp(score)
                best = max(best, (score, tuple(chosen)), key=lambda x: x[0])
        assert personal.marginals(segments, scores) == pytest.approx(list(weight / total))
        assert sum(scores[k] for k in personal.best_labelling(segments, scores)) == pytest.approx(max(best[0], 0))


def test_tables_and_learned_names(spark):
    docs = [(i, f"Shot by Osric Vandekar for the winter set number {i}.") for i in range(6)] + [(50, "osric vandekar stands near a wall."), (51, None), (52, ""), (53, " "), (None, "Shot by Amber Vessucci."), (0, "Shot by Osric Vandekar for the winter set number 0.")]
    docs.append((54, "word " * 20_000 + "Contact Amber Vessucci, amber@example.org, for files."))
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as kind", "2 as start_pos")
    n = spark.createDataFrame([*NAMES, (None, "x")], "given_name string, family_name string")
    rows = [tuple(r) for r in personal.find_personal(d, n).collect()]
    assert len(rows) == len(set(rows))
    assert {(0, "name", 9), (50, "name", 1), (54, "name", 100_009), (54, "email", 100_025)} <= set(rows) and {k for k, *_ in rows} == {0, 1, 2, 3, 4, 5, 50, 54}
    texts = {r["doc_id"]: r["text"] for r in personal.redact_personal(d, n).collect()}
    assert texts[50] == "[NAME] stands near a wall." and texts[51] is None and texts[52] == "" and texts[53] == " "
    assert personal.find_personal(d.limit(0), n).count() == 0 and personal.find_personal(d, n.limit(0)).count() > 0
