"""Problem 6: broken prompt and response pairs, by a multi-label linear classifier.

The classifier sees hashed n-grams of the response and features of the pair. It is
trained on a bounded sample of real attempts and on broken copies made from them:
emptied, cut off, refused, copied and swapped for one in another language.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.storage import spread

LABELS = ["empty", "copied_prompt", "refusal", "other_language", "truncated"]
#: Attempts that the classifier is fitted on at most.
SAMPLE_ROWS = 2000
#: Label of refusals in wordings that only the calibration sees.
UNSEEN = len(LABELS)
HASH_BITS = 17

# Frequent function words of languages that share the Latin script.
STOPWORDS = {
    "en": "the and with a an of in is are on from his her he she its to at over under behind near while for by this that be not or one both shows wears",
    "de": "der die das und mit ist sind eine ein einem einen einer nicht für den dem des auf zu zur aus im in vor weil wurde noch leicht gehört sich als",
    "fr": "le la les l et une un avec est sont des de du dans sur pas au aux devant que se il elle on encore d s parce deux un",
    "es": "el la los las y una un con es son de del en se al por que delante no lo está porque todavía algo su",
    "it": "il lo la le gli i e una un con è sono di in si che una davanti viene perché al alla della",
    "nl": "de het een en met is zijn van in op voor te naast omdat buiten om niet aan",
    "pt": "o a os as e uma um com é são de do da em no na se que não por ao",
}
# Words after which no sentence ends, and fragments that stand for a lost rest.
OPEN_WORDS = frozenset("the and with a an of from her his its at while by der die das und mit eine einem einen einer nicht für den dem des zur im weil le la les l et un une avec des de du dans sur au aux que el los las y una con del por".split())
DANGLING = ["with a", "and the", "the", "of", "a", "seen from", "with", "and", "mit einem", "und die", "avec un", "et la", "con una", "y la", "no", "from the", "in"]
# Parts of refusals in training; a refusal takes one of each, so that words and not sentences are learned. Every fifth
# core and object is kept for calibration only: thresholds are set on wordings that the classifier has not seen.
OPENERS = {
    "en": ["", "", "", "Sorry, ", "I'm sorry, but ", "Unfortunately ", "I apologize, but ", "I'm afraid ", "Regrettably, ", "Thanks, but ", "Hm, ", "As an AI, ", "As a language model "],
    "de": ["", "", "Leider ", "Tut mir leid, ", "Entschuldigung, "], "fr": ["", "", "Désolé, ", "Malheureusement, "], "es": ["", "", "Lo siento, ", "Lamentablemente, "],
}
CORES = {
    "en": [
        "I can't describe {o}", "I cannot help with {o}", "I am unable to caption {o}", "I'm not able to write about {o}", "I won't comment on {o}", "I will not do {o}", "I must decline {o}", "I have to refuse {o}", "I refuse to discuss {o}", "I decline to answer", "I would rather not talk about {o}", "I'd prefer not to say", "I prefer to leave {o} alone",
        "I do not caption {o}", "I don't write about {o}", "I don't have access to {o}", "I am not allowed to identify {o}", "I'm not permitted to judge {o}", "I may not speak about {o}", "I shouldn't describe {o}", "I could not open {o}", "I can't see {o}", "I have no way to look at {o}", "I have nothing to say about {o}", "my rules forbid {o}", "my guidelines do not let me describe {o}", "my instructions rule {o} out",
        "it is not possible for me to process {o}", "it would be wrong of me to judge {o}", "that is beyond what I do", "that is nothing I take part in", "{o} is outside my task", "{o} is against the content policy", "{o} breaks the rules, so no answer", "no caption can be given for {o}", "no answer to {o}", "this can't be done by me", "request rejected", "the request is denied", "task refused", "access denied", "not possible, {o} is blocked",
        "I am not comfortable with {o}", "I do not feel able to describe {o}", "I need to stop here", "count me out", "I must pass", "please ask someone else to describe {o}", "I can not assist you with {o}", "I'm going to skip {o}", "nothing can be said about {o}", "I am just a text model and see no pictures", "we are not able to serve {o}", "we cannot provide {o}",
    ],
    "de": ["kann ich {o} nicht beschreiben", "ich kann {o} nicht beantworten", "ich darf {o} nicht kommentieren", "ich möchte {o} nicht beurteilen", "ich muss {o} ablehnen", "ich bin nicht in der Lage, {o} zu sehen", "ich beschreibe {o} nicht", "das ist mir nicht möglich", "dazu sage ich nichts", "ich werde {o} nicht bearbeiten", "diese Anfrage wird abgelehnt", "dabei helfe ich nicht"],
    "fr": ["je ne peux pas décrire {o}", "je ne suis pas en mesure de traiter {o}", "je dois refuser {o}", "je refuse de commenter {o}", "je ne veux pas parler de {o}", "il m'est impossible de voir {o}", "je n'ai pas le droit de décrire {o}", "cette demande est refusée", "je ne réponds pas à {o}", "je préfère ne rien dire"],
    "es": ["no puedo describir {o}", "no me es posible comentar {o}", "debo rechazar {o}", "no quiero hablar de {o}", "no estoy autorizado a tratar {o}", "me niego a describir {o}", "no tengo acceso a {o}", "la solicitud está denegada", "no soy capaz de ver {o}", "prefiero no decir nada"],
}
OBJECTS = {
    "en": ["this picture", "the people in this photo", "that request", "this task", "the image", "the attachment", "real people", "this person", "what you ask", "faces", "private content", "this kind of material", "the file", "somebody's looks", "it"],
    "de": ["dieses Bild", "diese Person", "diese Bitte", "die Anfrage", "das Foto", "Gesichter"], "fr": ["cette photo", "cette personne", "cette demande", "l'image", "ces gens"], "es": ["esta imagen", "esta persona", "esta petición", "la foto", "estas caras"],
}
REFUSAL_TAILS = ["", "", "", " Try another picture.", " Is there anything else?", " Thank you for understanding.", " Ask me something different.", " It may show private things.", " That would not be right."]
# Third-person sentences with the words of refusals: no defect. {r} is a word taken from a refusal.
HARMLESS = [
    "The left hand cannot be seen fully.", "Her shoes are not visible.", "The label can't be read.", "The hem is cut off and will not fit in the frame.", "She declines a cup with one hand.", "He refuses to look at the lens.", "A sign behind says '{r}, {r}'.", "A shirt with {r} printed on it hangs on the wall.", "A poster about {r} is pinned to the door.", "The {r} poster is out of focus.",
    "Nobody else is able to enter the frame.", "The face is not hidden.", "There is no hat, no bag and nothing in the hands.", "The right arm is not in the picture.", "An apron with the word {r} covers the knees.", "The background does not distract.", "The people behind cannot be identified.", "It is not possible to see the feet.",
    "Die linke Hand ist nicht zu sehen.", "Die Schuhe kann man nicht erkennen.", "On ne voit pas les pieds.", "La main gauche n'est pas visible.", "No se ve la mano izquierda.", "Los pies no están en la foto.",
]
# What a model says before its answer.
PREAMBLES = ["", "", "", "Sure! ", "Certainly. ", "Here is the caption:\n\n", "**Caption:** ", "Description: ", "Of course, here it is: ", "Understood. ", "Prompt: ", "Here is what I see: ", "My caption: ", "I wrote this: "]

_BLANK = re.compile("[​‌‍⁠﻿­]")
_MARKUP = re.compile(r"```\w*|`|\*\*|__|</?[A-Za-z][^<>]{0,80}>|^\s*#+\s*|^\s*[-*•]\s+", re.M)
_LABEL = re.compile(r"^[\W_]*(?:[^\W\d_]+[ ]?){1,3}:\s*(?=$|\n)")
# A tag line, on as long as lines end with a comma, or a heading and the short lines below it.
_TAGS = re.compile(
    r"\n\s*(?:tags?|keywords|stichw[öo]rter|mots-clés|etiquetas)\s*:[ \t]*(?:(?:[^\n]*,[ \t]*\n)*[^\n]*\S[^\n]*|(?:\n[ \t]*[^\s.!?。]+(?:[ \t]+[^\s.!?。]+){0,2}[ \t]*(?=\n|$))*)",
    re.I,
)
_QUOTED = re.compile(r"(?<!\w)['\"“‘«„][^'\"”’»“\n]{3,160}['\"”’»“](?!\w)")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
LAST_LATIN = "ɏ"
_OPENING = re.compile(r"['\"“‘«„]([^'\"”’»“\n]{3,80})['\"”’»“]|start:\s*([^.\n]{3,80})", re.I)
# Words by which a writer speaks of itself, and negations, in the languages above.
_SPEAKER = re.compile(r"\b(?:i|me|my|myself|we|ich|mir|mich|mein\w*|je|j|moi|me|puedo|debo|siento|quiero|tengo|soy|estoy|prefiero|ik|io|posso|eu)\b", re.I)
_NEGATION = re.compile(r"\b(?:not|cannot|no|never|nothing|none|nicht|kein\w*|nichts|nie|ne|pas|rien|non|niet|geen|não|n)\b|n['’]t\b", re.I)
_STOP = {k: frozenset(v.split()) for k, v in STOPWORDS.items()}

_LANGUAGES = {w: [k for k, s in _STOP.items() if w in s] for s in _STOP.values() for w in s}


def strip_markup(text: str) -> str:
    """Text without markup, invisible characters, outer quotes and a lone label."""
    text = _MARKUP.sub(" ", _BLANK.sub("", text)).strip()
    return _LABEL.sub("", text).strip()


def shares(words: list[str]) -> dict[str, float]:
    """Share of each language's function words among the words."""
    n, seen = max(1, len(words)), dict.fromkeys(_STOP, 0)
    for w in words:
        for k in _LANGUAGES.get(w, ()):
            seen[k] += 1
    return {k: c / n for k, c in seen.items()}


def foreign_share(text: str) -> float:
    """Share of letters that are not of the Latin script."""
    if text.isascii():
        return 0.0
    letters = [c for c in text if c.isalpha()]
    return sum(c > LAST_LATIN for c in letters) / max(1, len(letters))


def prompt_facts(prompt: str) -> tuple[str, str, set, set]:
    """Language, prescribed opening, words and word trigrams of a prompt."""
    words = [w.lower() for w in _WORD.findall(_QUOTED.sub(" ", prompt))]
    own = shares(words)
    lang = max(own, key=own.get) if foreign_share(prompt) < 0.5 else "other"
    found = _OPENING.search(prompt)
    opening = (found.group(1) or found.group(2)).strip().lower() if found else ""
    every = [w.lower() for w in _WORD.findall(prompt)]
    return lang, opening, set(every), set(zip(every, every[1:], every[2:]))


DENSE = 38


def pair_features(prompt: str | None, content: str | None, facts: tuple | None = None) -> tuple[list[int], np.ndarray]:
    """Hashed n-grams (as places) and dense pair features of one attempt."""
    plain = strip_markup(content or "")
    body = _TAGS.sub("", plain)
    words = [w.lower() for w in _WORD.findall(body)]
    lang, opening, pwords, ptri = facts or (prompt_facts(prompt) if prompt else ("", "", set(), set()))
    low = body.lower().lstrip("\"'“‘«„ ")
    at = low.find(opening) if opening else -1
    free = low[at + len(opening) :] if 0 <= at <= 60 else low
    unquoted = _QUOTED.sub(" ", free)
    fwords = _WORD.findall(unquoted)
    n = len(words)
    x = np.zeros(DENSE)
    x[0] = 1
    x[1] = n == 0
    x[2] = 0 < n <= 5
    x[3] = min(n, 100) / 100
    tri = list(zip(words, words[1:], words[2:]))
    cover = len(ptri.intersection(tri)) / max(1, len(ptri))
    x[4] = cover
    x[5] = cover > 0.25
    x[6] = cover > 0.5
    x[7] = sum(t in ptri for t in tri) / max(1, len(tri))
    x[8] = sum(w in pwords for w in words) / max(1, n)
    foreign = foreign_share(unquoted)
    own = shares(fwords)
    mine = own.get(lang, 0.0)
    best = max((k for k in own), key=own.get)
    other = max((v for k, v in own.items() if k != lang), default=0.0)
    known = bool(prompt) and lang in _STOP
    x[9] = foreign > 0.5 and known
    x[10] = known and len(fwords) >= 4 and best != lang and other > mine + 0.04
    x[11] = known and len(fwords) >= 4 and other - mine
    x[12] = known and len(fwords) >= 4 and mine < 0.1
    x[13] = not prompt
    x[14] = x[10] * min(1.0, 5 * max(0.0, other - mine))
    x[15] = mine if known else 0.3
    tail = body.rstrip()
    core = tail.rstrip("\"'”’»“)*`] \n")
    last = core[-1:] if core else ""
    x[16] = last in tuple(".!?。！？")
    x[17] = bool(core) and last not in tuple(".!?。！？")
    x[18] = core.endswith("...") or last == "…"
    x[19] = last in tuple(",;:-–—(")
    ends = [w.lower() for w in _WORD.findall(core[-80:])]
    x[20] = bool(ends) and ends[-1] in OPEN_WORDS
    x[21] = bool(ends) and len(ends[-1]) <= 2
    x[22] = x[16] * x[20]
    x[23] = tail.count("“") > tail.count("”") or tail.count("(") > tail.count(")") or tail.count("«") > tail.count("»")
    x[24] = bool(opening) and not fwords and n > 0
    x[25] = bool(opening) and len(fwords) <= 3 and n > 0
    x[26] = body is not plain and body != plain
    x[27] = x[17] * (not x[18]) * (not x[19])
    sentences = [s for s in re.split(r"(?<=[.!?。])\s+", unquoted) if s.strip(" .,\n")]
    x[28] = len(sentences) <= 1
    x[29] = len(fwords) <= 22
    x[30] = cover > 0.1
    x[31] = foreign > 0.5
    x[32] = x[22] * (ends[-1] in ("a", "the", "an", "of", "with", "and") if ends else 0)
    x[33] = x[17] * x[20]
    own_voice = [bool(_SPEAKER.search(t)) for t in sentences]
    denied = [v and bool(_NEGATION.search(t)) for v, t in zip(own_voice, sentences)]
    x[34] = min(3, sum(denied)) / 3
    x[35] = sum(denied) / max(1, len(denied))
    x[36] = x[35] > 0.45
    x[37] = any(own_voice)
    mask, base = (1 << HASH_BITS) - 1, 0
    grams = [f"w {w}" for w in fwords] + [f"b {a} {b}" for a, b in zip(fwords, fwords[1:])]
    stop = "." if x[16] and not x[18] else "-"
    for k in (1, 2, 3):
        grams.append(f"t{k}{stop} {' '.join(ends[-k:])}")
    grams += [f"h {' '.join(fwords[:k])}" for k in (1, 2)]
    for t in sentences:
        first = _WORD.findall(t)
        grams += [f"s {' '.join(first[:2])}", f"s3 {' '.join(first[:3])}", f"e {' '.join(first[-2:])}"]
    return [base + (crc32(g.encode()) & mask) for g in grams], x


# ---- broken copies -----------------------------------------------------------------------------


def cut_off(text: str, rng: random.Random) -> str:
    """Text that breaks off inside a sentence, with or without a dangling word or stop."""
    body = strip_markup(text)
    spots = [m.start() for m in re.finditer(r"\s", body)]
    inner = [i for i in spots if not re.search(r"[.!?。]['\"”]?$", body[:i])]
    if not inner:
        return body[: max(1, len(body) // 2)]
    if rng.random() < 0.25:
        at = rng.choice(inner) + rng.randint(2, 4)
        at = at if at < len(body) - 2 and body[at - 1].isalpha() and body[at].isalpha() else rng.choice(inner)
    else:
        at = rng.choice(inner)
    head = body[:at].rstrip()
    if re.search(r"[.!?。]['\"”]?$", head):
        head += " " + rng.choice(DANGLING)
    r = rng.random()
    if r < 0.2:
        return head + " " + rng.choice(DANGLING) + rng.choice(["", ".", ".", ","])
    return head + rng.choice(["", "", "", "", "", ".", "...", "…", ",", " (seen from", " -", ".\"" if rng.random() < 0.2 else ""])


def copied(prompt: str, content: str, rng: random.Random) -> str:
    """The prompt instead of an answer, sometimes changed a little or followed by the answer."""
    words = prompt.split(" ")
    r = rng.random()
    if r < 0.25:
        words = [w if rng.random() > 0.1 else rng.choice(["simple", "clear", "plain", "foto", "text"]) for w in words]
    elif r < 0.4:
        k = int(len(words) * rng.uniform(0.6, 0.9))
        words = words[:k] if rng.random() < 0.5 else words[-k:]
    text = " ".join(words)
    if rng.random() < 0.3:
        text = text.lower()
    if rng.random() < 0.1:
        text = " ".join(text.split(" ")[: int(len(words) * rng.uniform(0.6, 0.95))]) + rng.choice(["", ".", "..."])
    return rng.choice(PREAMBLES) + text + ("" if rng.random() < 0.7 else "\n\n" + content)


def refused(opening: str, rng: random.Random, unseen: bool = False) -> str:
    """A refusal; ``unseen`` takes its core and object from those kept for calibration."""
    lang = rng.choices(list(CORES), [7, 1, 1, 1])[0]
    pick = lambda items: rng.choice([x for k, x in enumerate(items) if (k % 5 == 4) == unseen])

    def one(first: str) -> str:
        return first + pick(CORES[lang]).format(o=pick(OBJECTS[lang]))

    text = one(rng.choice(OPENERS[lang]))
    if rng.random() < 0.25:
        text += rng.choice([". ", "; ", ", and "]) + one("")
    text = text[:1].upper() + text[1:] + rng.choice([".", ".", ".", "!", ""]) + (rng.choice(REFUSAL_TAILS) if lang == "en" else "")
    if opening and rng.random() < 0.3:
        text = opening + ". " + text
    return text.lower() if rng.random() < 0.2 else text


def harmless(content: str, rng: random.Random) -> str:
    """A sound answer with words of refusals in it that decline nothing."""
    told = re.split(r"(?<=[.!?。])\s+", content)
    word = lambda m: rng.choice(re.findall(r"\w{4,}", refused("", rng)) or ["no"])
    told.insert(rng.randint(1, len(told)), re.sub(r"\{r\}", word, rng.choice(HARMLESS)))
    return " ".join(told)


def emptied(rng: random.Random) -> str | None:
    return rng.choice([None, "", " ", "\n\n", "-", "...", "```\n```", "<p></p>", "Caption:", "**Caption:**\n", "Description: \n\n", "​", " ", "Answer:", "``` ```", "**", "<br/>"])


#: Sentences in languages that the sample may lack as answers.
FOREIGN = {
    "it": ["La donna indossa una giacca grigia e guarda verso la finestra.", "Dietro di lei si vede un muro di mattoni, la luce è calda.", "Le mani sono in tasca e il viso è sereno."],
    "nl": ["De vrouw draagt een grijze jas en kijkt naar het raam.", "Achter haar is een stenen muur te zien, het licht is warm.", "De handen zijn in de zakken en het gezicht is rustig."],
    "pt": ["A mulher usa um casaco cinza e olha para a janela.", "Atrás dela vê-se uma parede de tijolos, a luz é quente.", "As mãos estão nos bolsos."],
    "ru": ["Женщина в серой куртке смотрит в окно.", "За ней видна кирпичная стена, свет тёплый."],
    "ja": ["女性は灰色の上着を着て窓を見ている。", "背景には煉瓦の壁が見える。光は暖かい。"],
    "en": ["The woman wears a grey jacket and looks at the window.", "Behind her a brick wall can be seen, and the light is warm.", "Both hands rest in the pockets, with a calm face."],
    "de": ["Die Frau trägt eine graue Jacke und schaut zum Fenster.", "Hinter ihr ist eine Mauer zu sehen, das Licht ist warm.", "Beide Hände liegen auf dem Tisch."],
    "fr": ["La femme porte une veste grise et regarde vers la fenêtre.", "Derrière elle on voit un mur de briques, la lumière est chaude.", "Elle tient un livre dans la main."],
    "es": ["La mujer lleva una chaqueta gris y mira hacia la ventana.", "Detrás de ella se ve una pared de ladrillo, la luz es cálida.", "Lleva un libro en la mano derecha."],
}


def training_pairs(rows: list[tuple[str | None, str | None]], seed: int = 29, unseen: float = 0.0) -> list[tuple[str | None, str | None, int]]:
    """(prompt, content, label place or -1) of the sample rows and of broken copies of them.

    ``unseen`` is the share of refusals in wordings kept for calibration; their label is ``UNSEEN``.
    """
    rng = random.Random(seed)
    by_lang: dict[str, list[str]] = {k: [" ".join(rng.sample(v, rng.randint(1, len(v)))) for _ in range(60)] for k, v in FOREIGN.items()}
    facts = [prompt_facts(p) if p else None for p, _ in rows]
    for (_, content), f in zip(rows, facts):
        if f and content:
            by_lang.setdefault(f[0], []).append(re.sub(r"^[^.]{0,60}\.\s*", "", strip_markup(content)) if f[1] else strip_markup(content))
    out = []
    for (prompt, content), f in zip(rows, facts):
        out.append((prompt, content, -1))
        if not content or len(content) < 40:
            continue
        wrap = rng.choice(PREAMBLES)
        out.append((prompt, wrap + cut_off(content, rng), 4))
        if rng.random() < 0.6:
            out.append((prompt, cut_off(content, rng), 4))
        r = rng.random()
        if r < 0.12:
            out.append((prompt, emptied(rng), 0))
        elif r < 0.42:
            new = rng.random() < unseen
            label = UNSEEN if new else 2
            out.append((prompt, rng.choice(PREAMBLES[:6]) + refused(f[1] if f else "", rng, new), label))
            if rng.random() < 0.4:  # after much of an answer, so that it may stand anywhere in the text
                told = re.split(r"(?<=[.!?。])\s+", strip_markup(content))
                head = " ".join(told[: rng.randint(1, len(told))])
                out.append((prompt, head + rng.choice([" ", "\n\n"]) + refused("", rng, new), label))
        elif r < 0.65 and prompt:
            out.append((prompt, copied(prompt, content, rng), 1))
        elif f and f[0] in _STOP:
            lang = rng.choice([k for k in by_lang if k != f[0] and len(by_lang[k]) > 5])
            text = rng.choice(by_lang[lang])
            if len(_WORD.findall(text)) >= 5 or lang == "ja":
                head = f[1] + ". " if f[1] and rng.random() < 0.4 else ""
                out.append((prompt, rng.choice(PREAMBLES[:7]) + head + text, 3))
        if rng.random() < 0.25:
            out.append((prompt, harmless(content, rng), -1))
        if rng.random() < 0.01:
            out.append((prompt, re.sub(r"[.。]\s*$", "", content), -1))
    return out


# ---- classifier --------------------------------------------------------------------------------


@dataclass(frozen=True)
class DefectModel:
    hashed: np.ndarray  # 2**HASH_BITS x labels
    dense: np.ndarray  # DENSE x labels
    threshold: np.ndarray

    def scores(self, places: list[int], x: np.ndarray) -> np.ndarray:
        """Probabilities of the labels."""
        z = x @ self.dense + (self.hashed[places].sum(axis=0) / np.sqrt(len(places) + 1.0) if places else 0)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(features: list[tuple[list[int], np.ndarray]], labels: np.ndarray, epochs: int = 6, rate: float = 0.08) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression per label by mini-batch AdaGrad with weight decay."""
    n, kinds = len(features), len(LABELS)
    target = np.zeros((n, kinds))
    target[np.flatnonzero(labels >= 0), labels[labels >= 0]] = 1
    hashed, dense = np.zeros((1 << HASH_BITS, kinds), "f4"), np.zeros((DENSE, kinds))
    gh, gd = np.full((1 << HASH_BITS, kinds), 1e-3, "f4"), np.full((DENSE, kinds), 1e-3)
    rng = np.random.default_rng(3)
    dense_rows = np.stack([x for _, x in features])
    for _ in range(epochs):
        order = rng.permutation(n)
        for i in range(0, n, 64):
            at = order[i : i + 64]
            sizes = np.array([len(features[j][0]) for j in at])
            flat = np.concatenate([np.asarray(features[j][0], "i8") for j in at])
            line = np.repeat(np.arange(len(at)), sizes)
            weight = 1 / np.sqrt(sizes + 1.0)
            z = dense_rows[at] @ dense
            np.add.at(z, line, hashed[flat] * weight[line, None])
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target[at]) / 8
            grad = dense_rows[at].T @ error + 1e-4 * dense
            gd += grad * grad
            dense -= rate * 4 * grad / np.sqrt(gd)
            places, back = np.unique(flat, return_inverse=True)
            part = np.zeros((len(places), kinds))
            np.add.at(part, back, error[line] * weight[line, None])
            part += 2e-4 * hashed[places]
            gh[places] += part * part
            hashed[places] -= rate * part / np.sqrt(gh[places])
    return hashed, dense


def suspicious(prompt: str | None, content: str | None) -> bool:
    """Whether an attempt is better not used as a sound example: no words, much of the
    prompt, another script or language, or mostly sentences that decline."""
    x = pair_features(prompt, content)[1]
    return bool(x[1] or x[5] or x[9] or x[10] or x[36])


def train(rows: list[tuple[str | None, str | None]]) -> DefectModel:
    """Fits the model to sample attempts, most of which must be sound.

    Suspicious attempts are no sound examples from the start; the sample's other broken
    attempts are found by a first fit and left out of the second. A fifth of the attempts is held
    out for calibration, with half of its refusals in wordings kept for that; each label's threshold
    is the one with the best F1 there when a defect is as rare as one pair in fifty. Held-out attempts
    that the classifier itself takes for broken are left out, as their labels are not known.
    """
    rows = [r for r in rows if not suspicious(*r)] or rows
    aside = [r for r in rows if crc32(str(r).encode()) % 5 == 0]
    rows = [r for r in rows if crc32(str(r).encode()) % 5] or rows
    facts: dict[str, tuple] = {}

    def features_of(pairs: list) -> list:
        return [pair_features(p, c, _facts_of(p, facts)) for p, c, _ in pairs]

    for turn in range(2):
        pairs = training_pairs(rows, seed=29 + turn)
        features, labels = features_of(pairs), np.array([k for _, _, k in pairs])
        model = DefectModel(*_fit(features, labels), np.full(len(LABELS), 0.5))
        if turn == 0:  # most broken attempts of the sample are still in it at first, so little is enough to leave one out
            broken = {(p, c) for (p, c, k), f in zip(pairs, features) if k < 0 and model.scores(*f).max() > 0.25}
            rows = [r for r in rows if r not in broken] or rows
    aside = [r for r in aside if model.scores(*pair_features(*r, _facts_of(r[0], facts))).max() < 0.5]
    pairs = training_pairs(aside, seed=31, unseen=0.5)
    scored = np.stack([model.scores(*f) for f in features_of(pairs)]) if pairs else np.zeros((0, len(LABELS)))
    truth = np.array([LABELS.index("refusal") if k == UNSEEN else k for _, _, k in pairs])
    threshold = np.full(len(LABELS), 0.5)
    for k in range(len(LABELS)):
        good, bad = scored[truth == k, k], scored[truth != k, k]
        if len(good) < 5 or len(bad) < 5:
            continue
        grid = np.linspace(0.02, 0.98, 97)
        hits = np.array([(good >= t).mean() for t in grid])
        false = np.array([(bad >= t).mean() * 49 for t in grid])
        f1 = 2 * hits / np.maximum(1 + hits + false, 1e-9)
        top = np.flatnonzero(f1 >= f1.max() - 1e-3)
        threshold[k] = grid[top[len(top) // 2]]
    return DefectModel(model.hashed, model.dense, threshold)


def _facts_of(prompt: str | None, known: dict[str, tuple]) -> tuple | None:
    """Facts of a prompt, kept for the next attempts at it; ``known`` is emptied when it has grown large."""
    if not prompt:
        return None
    if (facts := known.get(prompt)) is None:
        if len(known) > 10_000:
            known.clear()
        facts = known[prompt] = prompt_facts(prompt)
    return facts


def decide(model: DefectModel, prompt: str | None, content: str | None, facts: tuple | None = None) -> str | None:
    """The defect of one attempt or None. If several labels pass, the first in ``LABELS`` counts:
    an empty, copied or refusing answer is named so even if it also breaks off."""
    p = model.scores(*pair_features(prompt, content, facts))
    return next((name for name, score, t in zip(LABELS, p, model.threshold) if score >= t), None)


def broken_pairs(attempts: DataFrame) -> DataFrame:
    """``attempt_id`` and ``defect`` of the defective attempts.

    ``attempts`` has ``attempt_id``, ``base_prompt`` and ``content``. A null or blank
    content is empty; without a prompt only the response is judged, and copying
    and language cannot be a defect; a null id gives no row; repeated rows give one. An
    empty table gives no rows. Texts are judged whole. The model is fitted on at most
    ``SAMPLE_ROWS`` attempts, chosen by a hash of the id, and broadcast (its
    size is fixed); every attempt is judged by it.
    """
    spark = attempts.sparkSession
    rows = attempts.select(F.col("attempt_id").cast("long").alias("attempt_id"), "base_prompt", "content").where("attempt_id is not null")
    n = rows.count()
    place = F.pmod(F.xxhash64("attempt_id", F.lit(5)), F.lit(1 << 30))
    picked = rows.where(place < int(min(1.0, 1.2 * SAMPLE_ROWS / max(n, 1)) * (1 << 30))).orderBy(place, "attempt_id", F.xxhash64("content")).limit(SAMPLE_ROWS)
    sample = sorted({(r["base_prompt"], r["content"]) for r in picked.collect()}, key=str)
    schema = "attempt_id long, defect string"
    if not sample:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(train(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, facts = shared.value, {}
        for batch in batches:
            ids, kinds = [], []
            for key, prompt, content in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if kind := decide(model, prompt, content, _facts_of(prompt, facts)):
                    ids.append(key)
                    kinds.append(kind)
            yield pa.RecordBatch.from_pydict({"attempt_id": pa.array(ids, pa.int64()), "defect": pa.array(kinds, pa.string())})

    return spread(rows).mapInArrow(run, schema).groupBy("attempt_id").agg(F.min("defect").alias("defect"))
