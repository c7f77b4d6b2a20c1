"""Problem 9: personal information in free text, by a semi-Markov conditional random field.

A labelling of a text is a set of segments: entities (name, email, phone, identity
number, street address) of bounded length, and single characters outside. Only
segments of a lexically possible form can be entities; each is scored as a
whole by features of its form, its words and its surroundings, everything outside
scores 0. Dynamic programming over the segment bounds gives the partition
function and marginals in training, and the best joint choice of bounds and
types in use. The model is trained here on generated sentences.

Names that are on no list are scored as well where their words are capitalised or
follow a title; the field decides by their surroundings. Words that keep appearing
in the corpus as given or family names are learned in a first pass: they are a
feature of the second, and are possible names there in lower case, too.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.storage import materialize, spread

KINDS = ["name", "email", "phone", "identity_number", "street_address"]
HASH_SIZE = 1 << 15
#: Longest entity in characters, the bound of the dynamic programming. Mail addresses have at most 320, phone numbers 15 digits.
MAX_SPAN = 1000
#: Names read from the list, and words learned from the corpus, that are broadcast at once.
LEXICON_WORDS = 500_000

# ---- forms -------------------------------------------------------------------------------------

_AT = r"(?:@|\s{0,2}[\[(]\s?at\s?[\])]\s{0,2}|\s{1,2}at\s{1,2})"
_DOT = r"(?:\.|\s{0,2}[\[(]\s?dot\s?[\])]\s{0,2}|\s{1,2}dot\s{1,2})"
_EMAIL = re.compile(rf"(?<![\w.+-])\w[\w.+-]*{_AT}[\w-]+(?:{_DOT}[\w-]+)*{_DOT}[^\W\d_][\w-]*", re.I)
_DIGITS = re.compile(r"(?<![\w.,:/@+-])(?:\+\s?|\()?\d+(?:(?:[ \xa0.\-/]|\)[ \xa0]?|[ \xa0]\()\d+)*(?![\w@])")
# Letters belong to a number if they touch it or a hyphen ties them to it; behind a blank only in capitals, or in pairs as below.
_IDENTITY = [
    re.compile(r"(?<![\w.+@-])(?:[A-Z]{1,2}-?)?\d{2,9}(?:[ .\-]\d{2,4}){0,3}(?:-?[A-Z])?(?![\w@])", re.I),
    re.compile(r"(?<![\w.+@-])[A-Z]{2}(?:[ ]\d{2}){3}[ ][A-Z](?![\w@])", re.I),
    re.compile(r"(?<![\w.+@-])\d{7,8}[ ][A-Z](?![\w@])"),
]
_STREETS = r"street|st|avenue|ave|road|rd|lane|ln|court|ct|terrace|mews|boulevard|blvd|drive|way|square|close|crescent|row|place|parkway|highway"
_S = r"[ \t\xa0]{1,3}"
_W = r"(?:[^\W\d_][\w'’-]*|[^\W\d_]{1,3}\.)"
_NUM = r"\d{1,4}(?:[ ]?[a-z])?(?:[ ]?[-–/][ ]?\d{1,4}[a-z]?)?"
_WIDE = "Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Court|Terrace|Mews|Boulevard|Blvd|Drive|Way|Square|Close|Crescent|Row|Place|Parkway|Highway|Grove|Gardens|Walk|Alley|Trail|Circle|Plaza|Wharf|Embankment|Parade|Rise"
_ADDRESS = [
    ("en", re.compile(rf"(?<![\w.,-]){_NUM},?{_S}(?:{_W}{_S}){{1,3}}?(?:(?:st|ave|rd|ln|ct|blvd)\.|(?:{_STREETS})\b(?:{_S}(?:{_STREETS})\b)?)", re.I)),
    # any number of words and more kinds of street where all of them are capitalised
    ("en_cap", re.compile(rf"(?<![\w.,-])(?:{_NUM}),?{_S}(?:[A-ZÀ-Þ][\w'’.-]*{_S})+?(?:(?:St|Ave|Rd|Ln|Ct|Blvd|ST|AVE|RD|LN|CT|BLVD)\.|(?:{_WIDE}|{_WIDE.upper()})\b)")),
    ("en_after", re.compile(rf"(?<![\w-])(?:[A-Z]{_W}{_S}){{1,3}}(?:{_STREETS})\.?,?{_S}(?:no\.?\s?)?\d{{1,4}}[a-z]?\b", re.I)),
    ("de", re.compile(rf"(?<![\w-])(?:[\w.'’-]*(?:stra(?:ß|ss)e|str\.?|gasse|allee)|[\w.'’-]{{2,}}(?:weg|platz|damm|ufer|ring)){_S}\d{{1,4}}(?:\s?[a-z])?(?!\w)", re.I)),
    ("de_at", re.compile(rf"(?<![\w-])(?:Am|Im|Zum|Zur|Beim|(?:An|In|Auf|Unter|Hinter|Vor|Bei)[ ]de[nmr]){_S}(?:[A-ZÄÖÜ][\w-]*e[nmr]{_S})?[A-ZÄÖÜ]?[\wäöüß-]*(?:[Mm]arkt|[Gg]raben|[Tt]or|[Bb]ach|[Bb]erg|[Kk]irche|[Pp]ark|[Hh]of|[Ww]all|[Ss]ee|[Ww]ald|[Aa]nger|[Bb]runnen|[Dd]om|[Ff]eld|[Ss]teig|[Ll]inden|[Mm]ühle|[Aa]ue|[Ww]iese)n?{_S}\d{{1,4}}(?:\s?[a-z])?(?!\w)")),
    ("es", re.compile(rf"(?<![\w-])(?:calle|c/|avenida|avda\.?|paseo|plaza|camino|via|viale|corso)[ \t\xa0]{{0,3}}(?:de{_S})?(?:{_W}{_S}){{0,3}}?{_W},?{_S}\d{{1,4}}\b", re.I)),
    ("fr", re.compile(rf"(?<![\w.,-])\d{{1,4}}(?:\s?(?:bis|ter))?,?{_S}(?:rue|avenue|boulevard|chemin|place|quai|allée|impasse|cours){_S}(?:de\s|du\s|des\s|d['’])?(?:la\s)?{_W}(?:[ ](?-i:[A-Z])[\w'’-]*)?", re.I)),
]
# What a form cannot do without, looked for first where the form itself is slow.
_NEEDS = {
    "en_cap": re.compile(rf"\d,?{_S}[A-ZÀ-Þ]"),
    "en_after": re.compile(rf"\b(?:{_STREETS})\.?,?{_S}(?:no\.?\s?)?\d", re.I),
    "de": re.compile(rf"(?:stra(?:ß|ss)e|str\.?|weg|gasse|allee|platz|damm|ufer|ring){_S}\d", re.I),
}
_TOKEN = re.compile(r"(?:[^\W\d_]|Ã.)+(?:['’\-](?:[^\W\d_]|Ã.)+)*")

# Titles, particles of family names, endings of file names.
TITLES = frozenset("mr mrs ms miss dr prof professor sir madam herr frau fräulein mme mlle monsieur madame señor señora sr sra srta don doña signor signora dott".split())
PARTICLES = frozenset("van von de la der den del della di da du le ten ter dos das y zu".split())
FILE_ENDINGS = frozenset("png jpg jpeg webp gif txt pdf zip tif tiff bmp json csv".split())

LISTED, LEARNED, UNKNOWN = "K", "L", "U"


@dataclass(frozen=True)
class Lexicon:
    """Lower-case given and family names, from the list or learned."""

    given: dict[str, str] = field(default_factory=dict)
    family: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def of(rows: list) -> "Lexicon":
        """From (role, word, status) rows; a listed word stays listed if it is learned as well."""
        out = Lexicon({}, {})
        for role, word, status in rows or []:
            words = out.given if role == "g" else out.family
            if words.get(word) != LISTED:
                words[word] = status
        return out

    def given_status(self, word: str) -> str:
        return self.given.get(word, UNKNOWN)

    def family_status(self, word: str) -> str:
        if (status := self.family.get(word)) is not None:
            return status
        if "-" in word:
            parts = {self.family.get(p, UNKNOWN) for p in word.split("-")}
            return LISTED if LISTED in parts else LEARNED if LEARNED in parts else UNKNOWN
        return UNKNOWN


@dataclass
class Segment:
    """A possible entity: place, kind and hashed features."""

    start: int
    end: int
    kind: int
    features: list[int]
    words: tuple[str, str] = ("", "")


def _hash(kind: int, name: str) -> int:
    return crc32(f"{kind}|{name}".encode()) % HASH_SIZE


def _context(text: str, start: int, end: int) -> list[str]:
    left = re.findall(r"[^\W\d_]+|[^\w\s]|\d", text[max(0, start - 40) : start])[-3:]
    right = re.findall(r"[^\W\d_]+|[^\w\s]|\d", text[end : end + 30])[:2]
    left = [w.lower() for w in left]
    right = [w.lower() for w in right]
    out = [f"l1 {left[-1] if left else '^'}", f"r1 {right[0] if right else '$'}"]
    words = [w for w in left if w.isalpha()]
    if words:
        out.append(f"lw {words[-1]}")
    if len(words) > 1:
        out.append(f"lw2 {words[-2]} {words[-1]}")
    if len(right) > 1:
        out.append(f"r2 {right[0]} {right[1]}")
    return out


def _shape(text: str) -> str:
    return re.sub(r"[^\W\d_]", "A", re.sub(r"\d", "9", text.replace(" ", " ").lower()))


def _number_features(text: str, kind: int, start: int, end: int) -> list[str]:
    s = text[start:end]
    digits = sum(c.isdigit() for c in s)
    groups = re.findall(r"\d+", s)
    shape = _shape(s)
    return [
        f"shape {shape}", f"lens {'-'.join(str(len(g)) for g in groups)}", f"digits {min(digits, 16)}", f"groups {min(len(groups), 6)}", f"first {s[0] if not s[0].isdigit() else '9'}",
        f"zero {groups[0][0] == '0' if groups else 0}", f"seps {''.join(sorted(set(re.sub(r'[0-9A]', '', shape))))}", f"longest {max(map(len, groups), default=0)}", f"letters {'A' in shape}",
    ]


def _email_features(text: str, start: int, end: int) -> list[str]:
    s = text[start:end].lower()
    at = "@" if "@" in s else "b" if re.search(r"[\[(]\s?at", s) else "w"
    domain = re.split(_AT, s, maxsplit=1)[-1]
    parts = [p for p in re.split(_DOT, domain) if p]
    ending = parts[-1] if parts else ""
    local = re.split(_AT, s, maxsplit=1)[0]
    return [
        f"at {at}", f"dots {'.' in domain} {'dot' in domain}", f"at {at} dots {'dot' in domain}", f"file {ending in FILE_ENDINGS}", f"ending {len(ending) if ending.isalpha() else 0}",
        f"short {len(parts[0]) <= 2 if parts else 1}", f"marks {bool(re.search(r'[._+0-9-]', local))}", f"at {at} marks {bool(re.search(r'[._+0-9-]', local))}", f"parts {min(len(parts), 4)}", f"digit domain {parts[0][:1].isdigit() if parts else 1}",
    ]


def _address_features(text: str, form: str, start: int, end: int) -> list[str]:
    s = text[start:end]
    words = _TOKEN.findall(s)
    low = [w.lower() for w in words]
    cased = [w for w in words if len(w) > 1]
    inner = low[:-1] if form.startswith("en") else low[1:]
    plain = sum(w in COMMON for w in inner)
    street = low[-1] if form.startswith("en") and low else low[0] if low else ""
    return [
        f"form {form}", f"caps {all(w[:1].isupper() for w in cased)}", f"lower {all(w.islower() for w in cased)}", f"plain {min(plain, 2)}", f"form {form} plain {min(plain, 2)}",
        f"words {len(words)}", f"street {street}", f"break {'. ' in s.rstrip('.') and not re.search(r'(?i)\bst\. ', s)}", f"line {chr(10) in s}",
    ]


# Function and everyday words that are seldom part of a street's or a person's name.
COMMON = frozenset(
    "the a an and or of in on at to for from with by is are was were be been this that these those it its as into over under near behind after before while when then than not no all some any each one two three "
    "he she they we you i his her their our my your who which what how first last second next images image frame frames pictures picture shot shots words set pass caption light full body close down up out off "
    "der die das und mit ein eine einem einen von vor zu im am ist sind wird nicht le les des et un une dans sur avec est pas el los las y con una uno se en que por no del al il lo gli e di che si".split()
)


def _cased(text: str) -> str:
    letters = [c for c in text if c.isalpha()]
    if not letters:
        return "-"
    if all(c.isupper() for c in letters):
        return "U"
    return "T" if letters[0].isupper() else "l"


def _repaired(word: str) -> str:
    """Lower case, wrong decoding undone where that is possible."""
    if "Ã" in word:
        for code in ("cp1252", "latin-1"):
            try:
                return word.encode(code).decode("utf-8").lower()
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
    return word.lower().replace("’", "'")


# ---- generated training sentences ---------------------------------------------------------------

_GIVEN_BITS = ["al", "ber", "cor", "da", "el", "fi", "gre", "ha", "is", "jo", "ka", "lu", "ma", "no", "ol", "pe", "ru", "sa", "te", "vi", "wil", "zo"]
_GIVEN_ENDS = ["na", "rik", "la", "ne", "ton", "mira", "dan", "ia", "ette", "bert", "sine", "o"]
_FAMILY_ENDS = ["man", "berg", "field", "ski", "son", "ova", "ley", "ini", "ez", "aud", "ström", "mann", "well", "ker", "dorf", "ard"]
_STREET_NAMES = ["Walnut", "Chapel", "Queen's", "Abbey", "Green Lion", "Market", "Elm", "Red Barn", "South Gate", "St. John", "Albert", "Potter", "Bridge", "Orchard", "New Bridge", "Saint Anne Hill", "Little West Park", "Orchard Row", "Lion Court", "Hill Close", "Upper Stone Cross"]
# All sentences are written for this generator. {n} name, {f} family name, {e} email, {p} phone, {i} identity number, {a} {d} {s} {r} addresses, {v} verb,
# {G} {g} listed given name as a plain word, {U} invented capitalised word, {w} plain or invented word, {C} letter, {999} digits.
_NAME_SLOTS = [
    "Photographer: {n}", "Stylist {n}, assistant {n}", "Hair and make-up: {n}", "Retouching was done by {n}", "Credit goes to {n} for the light.", "Best regards,\n{n}", "Signed: {n}", "Signed, {n}", "Consent was given by {n} on Tuesday.", "Waiver from {n} received.",
    "{n} signed the waiver.", "{n} called about the contract.", "{n} wrote that the colours are wrong.", "{n} would like two copies.", "{n} said yes to all of it.", "I spoke with {n} about the dates.", "We thank {n} for the help.", "We thank {n}", "We owe {n} a dinner.", "The portrait of {n} came out dark.", "a portrait of {n}, seated", "Ask {n} first.", "Call {n} at noon.", "Meet {n} here.", "Paid {n} in cash.", "Contact was {n} at first.", "Thank {n} for it.", "Saw {n} there.", "Write to {n} or call {n}.", "Signed by {n} only.", "Contact {n} ({p})", "Signed {n}, {e}",
    "as {n} told us, the roll is lost", "tell {n} that the files are ready", "send everything to {n}, {a}", "{n}, {a}", "{n}, {a}, {U} {U}", "a letter for {n}, {a}, {U}",  "{n}, {e}, has them", "the file of {n}, {w} and {w}", "Guardian: {n}, phone {p}", "Name: {n}\nPhone: {p}\nE-mail: {e}", "Model {n} ({p})", "{n} <{e}>", "From: {n} <{e}>", "invoice for {n}, {a}", "{n} lives at {a}.", "{n} can be reached on {p} or {e}.",
    "{n} ({e}) wants the raw files", "The name {n} is on the back of the print.", "Booking for {n}; document {i}; {p}.", "Mr. {f} came by at ten.", "Mrs {f} rang the bell.", "Ms {f} wants a refund.", "Ms. {f} agreed to it.", "Dr. {f} said yes.", "Dr. {n} agreed.", "Prof. {f} lent us the hall.", "Miss {f} was late.", "according to Dr {f}, fine", "the name tag says {n}", "a mug with the words '{n}' on it", "photo by {n}", "edited by {n} and {n}",
    "{n} and {n} share the frame.", "{n} {v} beside a window.", "{n} {v} with a cup in one hand.", "{n} {v} on a bench, arms folded.", "{n} {v}, a lamp behind.", "{n} is seen from below, {w} and {w}.", "A man, {n}, {v} at the door.", "In the doorway {n} {v} and laughs.", "Here {n} wears a wool coat.", "On the left {n} holds a lamp.", "The sitter is {n}.", "The sitter, {n}, is over eighteen.", "Under the {w} {n} {v} alone.",
    "Holder of document {i}: {n}.", "passport {i}, issued to {n}", "This one of {n} is soft.", "Removed at the wish of {n}.", "forwarded by {n} yesterday", "Question for {n}: which frame?", "{w} {w} {n} {w} {w}.", "{w} {n}, {w}.", "{w}: {n}; {w}", "then {n} {w} the {w}", "{w} by {n} in {w}", "{w} for {n}.",
    "Unterschrieben von {n}.", "{n} hat unterschrieben.", "Kontakt: {n}, Telefon {p}", "Herr {f} kommt um zehn.", "Frau {f} möchte Abzüge.", "Das Bild zeigt {n}.", "Zusage von {n} ist da.", "Danke an {n} für das Licht.", "Model: {n}, wohnhaft {d}", "Mit freundlichen Grüßen\n{n}", "Die Erlaubnis hat {n} erteilt.",
    "Signé par {n}.", "Merci à {n} pour la lumière.", "Contact : {n}, tél. {p}", "Madame {f} veut deux tirages.", "Sur la photo, {n} sourit.", "{n} est d'accord.", "Portrait de {n}, tél. {p}", "Image de {n}, prise en mai", "Tirage de {n}, {w} au {p}", "{w} de {n}, {w}.", "Retrato de {n}, {w} {w}", "Firmado por {n}.", "Gracias a {n} por la luz.", "Contacto: {n}, tel. {p}", "La señora {f} llamó ayer.", "Sr. {f} vino a las diez.", "En la foto, {n} sonríe.", "{n} está de acuerdo.",
]
_OTHER_SLOTS = [
    "Phone: {p}", "phone {p}", "ring {p} after six", "text me on {p}", "or call {p}.", "Fax {p}", "his mobile is {p}", "the number {p} is out of order", "a sign with {p} on it", "a poster says call {p}", "Tel {p}", "tel: {p}", "a van with {p} on the door", "{p} is painted on the wall", "{w} {w} {p} {w}", "{w}: {p}", "Telefon: {p}", "Rückruf unter {p}", "tél. {p}", "appelez le {p}", "llame al {p}", "teléfono {p}", "on {p}, or by mail: {e}", "his number is {p}", "find us at {p}, any day", "the office at {p} knows", "{w} at {p} {w}", "{a}; bell {p}",
    "Email: {e}", "mail {e} for access", "write to {e}", "send it to {e} by noon", "contact {e} or {e}", "{e} bounced", "my address is {e}", "{w} {e} {w}", "{w}: {e}", "E-Mail: {e}", "per Mail an {e}", "courriel : {e}", "correo: {e}", "you can find me under {e}", "mailto:{e}",
    "Social security number {i}", "SSN {i}", "ssn: {i}", "my SSN is {i}.", "Passport no. {i}", "passport {i}", "his passport is {i}", "passport number {i} was visible", "National ID {i}", "ID card {i}", "the id is {i}", "Tax ID {i}", "tax number {i}", "driving licence {i}", "licence no {i}", "a card with {i} on it", "the document {i} was shown", "{w} number {i}, {w}", "identity number: {i}", "ID no. {i}, blurred later", "Personalausweis {i}", "Steuernummer {i}", "Ausweis: {i}", "carte d'identité {i}", "passeport n° {i}", "DNI {i}", "pasaporte {i}", "NIF: {i}", "permis {i}", "Führerschein {i} liegt vor",
    "Address: {a}", "ship to {a}", "the studio is at {a}.", "come to {a} at nine", "we shot at {a}, second floor", "deliver to {a}, please", "she lives at {a}", "in front of {a} we waited", "the house at {a} burned", "pick-up: {a}", "{a}, {U}", "{a}, {U} {U}.", "sent to {a}, {U} {U}, by post", "'{a}, {U} {U}' on the box", "{w} {w} {a} {w}", "{w} to {a}.", "Adresse: {d}", "wir treffen uns in der {d}", "Studio: {d}", "geliefert an {d}", "Treffen: {d}.", "dirección: {s}", "el estudio está en {s}", "entrega en {s}", "adresse : {r}", "rendez-vous au {r}", "livrer au {r}",
]
_DECOYS = [
    "Order {9999999} shipped in {99} boxes.", "Ticket #{99999} closed.", "seed {9999999999}, steps {99}, cfg {9}.{9}", "random seed {999999999}", "IMG_{9999}.jpg, DSC{99999}.png", "file_{99}@{9}x.webp", "icon@{9}x.png in the folder", "{99}.{99}.20{99} {99}:{99}", "20{99}-0{9}-1{9}T1{9}:{99}:{99}", "20{99}:1{9}:0{9} 0{9}:{99}:{99} in the header", "20{99}-0{9}-0{999} used batch {99}", "f/{9}.{9}, 1/{999} s, ISO {999}", "{99} mm lens at {999} cm", "serial number {999}-{9999}-{9999}", "body no. {C}{C}-{9999}-{999}-{9999}", "Serial {C}{C}{99999999} on the body", "model no. {C}{9999}-{99}",
    "lot {9999}-{9999}", "batch {99}-{9999}, shelf {9}", "checksum {99999999}", "lr 0.000{9}, batch {99}, epoch {99}", "loss 0.{99999999} at step {9999}", "step 00{9999} of {99999}", "{9}.{99999999} on the dial", "{9999}x{9999} px, {99}.{9} MB", "10.{9}.{99}.{99} port {9999}", "version {9}.{99}.{9}", "build {9999}.{9}.{9999}.{99}", "price {9}.{999},{99} EUR", "Total: {9999}.{99} for roll {99}", "{99} of {999} frames kept", "{99} % rejected", "frames {99} to {99} are fine", "{99} close-ups and {99} others", "room {999}, {99} chairs", "page {99}, line {9}", "colour #{9}{C}{9}{C}{99}",
    "barcode {9} {999999} {999999}", "ISBN 978-{9}-{99}-{999999}-{9}", "ISBN {999}-{9}-{999}-{99999}-{9}", "invoice {9999}-{999}", "box {999}, {99}, {999}, {999}", "boxes {9999} {999} {999} {9999}", "{9}e-0{9} and 0x{9}F", "Queue {99}/{999}, {99}.{9} GB left", "user {99999}, group {9999}", "posted by @{g}_{99}", "@{g}.{w} #{w}{99}", "parcel {9999} {9999} {9999} {9999}", "account balance {9999999}", "{w} {9999999} {w}", "{w} {99} {w}, {999} {w}", "the answer is {99}.{9999999}", "Seed: {9999999999}", "seed {9999999999} {w} {w}", "with seed {0999999999} again", "{9}.{99999999999999} and more digits", "during {99} minutes", "spring 20{99}, roll {9}", "a string of {99} lamps", "string {9} of {99}", "{w} at {99}.{999} {w}",
    "The {G} curtain is heavy.", "{G} green, {G} grey and {G} blue swatches", "a {g} scarf on a {g} chair", "The {G} preset is too warm.", "{G} lens, {G} filter.", "the {G} Tower in the background", "{G} Street fair", "{G} Lake at dawn", "{G} & Sons tripod", "Team {G} lunch", "at the {G} Hotel", "{G} Road was closed.", "in {g} tones", "{G} White and {G} Sand are the paints.", "paint: {G} {U} Blue", "{G} {U} Grey for the wall, {G} {U} for the door", "the cloth, {G} {U} Red", "{G} Studio has two rooms.", "Try the {G} look, {G} light and {G} tint.", "{G}, {g} and rust",
    "the {U} {U} lens", "The {U} {U} preset is warm.", "{U} {U} is the name of the cloth.", "near {U} {U}", "in {U} {U} we stopped", "a {U} {U} bag", "the {U} {U} market", "the {U} and {U} kit", "a {U} {99} camera", "The {U} Film {99} is grainy.", "the market in {U} {U}", "on the way to {U} {U}", "{U} Hall was empty", "{U} Bay, {U} Hill and {U} Point are far.", "made in {U}", "{U} {U} opens at ten.", "Lens: {U} {U} {99} mm", "Location: {U} {U}, {U}", "the {U} River and the {U} Bridge",
    "{99} people on the street", "{9} lanes of the road", "{99} steps to the court", "a street lamp and {99} doors", "{9} boats near the quay", "the road at number {9} is closed", "Write {99} words on the square format.", "Look at the {w} dot on the {w}.", "We met at the gate at ten.", "Stay at the {w}. It is {w}.", "flat {9}{C}, top bell", "{9}th floor, door {C}",
    "A {w} of {w} {w}, {w} {w} and the {w} of {w} {w}.", "Look for {w} {w} first, then {w} {w} on the {w}.", "The {w} {w} the {w} by {w}, then {w} {w} toward the {w}.", "Note: {w} {w}, three {w} {w}; a {w} of {w} {w} unless it {w} both {w}.", "She {v} in the {w}, {w} {w}.", "Soft light, dark {w}, hard {w}.", "Close-Up, Medium Shot, Full Body", "Monday Morning: {w} {w}", "Rule {9}: Never {w} the {w}.", "Good Caption, Bad Caption", "Portrait, Frontal, Indoor; {w}, {w}", "Warm Light. Cold Shadow.", "Tags: {w}, {w}, {w}",
    "Die Kamera steht am Fenster, Blatt {99}.", "Im Ordner {99} liegen {999} Bilder.", "Am Montag {99} Uhr, Raum {9}.", "In der Mappe {99} fehlt ein Blatt.", "Rote Jacke, blaue Hose, Seite {99}.", "Das Licht kommt von links.", "Eine Frau {v} am Markt.", "La lumière vient de gauche, page {99}.", "Une femme en veste {g}, plan {99}.", "La luz viene de la izquierda, hoja {99}.", "Una mujer con abrigo {g}, toma {9}.", "En la calle hay {99} sillas.", "Dans la rue, {99} chaises.", "Unter dem Tisch liegen {99} Kabel.",
]


# Plain words of descriptions, for sentences without names.
_THINGS = "glass stone rope brass cotton ladder bucket lantern dusk fog rain iron paper kettle chair oak clay broken golden empty dusty painted carries holds folds turns waits morning corner shelf bench".split()

_VERBS = "stands sits leans rests kneels walks crouches waits looks smiles bends turns poses laughs".split()


def _digits(rng: random.Random, shape: str) -> str:
    return re.sub("9", lambda _: str(rng.randint(0, 9)), shape)


class Sentences:
    """Makes sentences with known entities; names come from the list, or are invented to stand for others."""

    def __init__(self, names: list[tuple[str, str]], seed: int):
        self.rng = random.Random(seed)
        self.given = sorted({g for g, _ in names}) or ["Anna", "Peter"]
        self.family = sorted({f for _, f in names}) or ["Miller", "Okafor"]
        self.status: dict[str, str] = {}
        self.pool_given = {LEARNED: [self._given() for _ in range(25)], UNKNOWN: [self._given() for _ in range(60)]}
        self.pool_family = {LEARNED: [self._family() for _ in range(25)], UNKNOWN: [self._family() for _ in range(60)]}

    def _given(self) -> str:
        return "".join(self.rng.sample(_GIVEN_BITS, self.rng.randint(1, 2)) + [self.rng.choice(_GIVEN_ENDS)]).capitalize()

    def _family(self) -> str:
        name = (self.rng.choice(_GIVEN_BITS) + self.rng.choice(_GIVEN_BITS) + self.rng.choice(_FAMILY_ENDS)).capitalize()
        return "O'" + name if self.rng.random() < 0.08 else name

    def lexicon(self) -> Lexicon:
        given = {g.lower(): LISTED for g in self.given} | {g.lower(): LEARNED for g in self.pool_given[LEARNED]}
        family = {f.lower(): LISTED for f in self.family} | {f.lower(): LEARNED for f in self.pool_family[LEARNED]}
        return Lexicon(given, family)

    def _pick(self, listed: list[str], pools: dict[str, list[str]], level: str) -> str:
        return self.rng.choice(listed if level == LISTED else pools[level])

    def name(self, family_only: bool = False) -> str:
        r = self.rng
        level = r.choices([LISTED, LEARNED, UNKNOWN], [5, 3, 2])[0]
        family = self._pick(self.family, self.pool_family, level)
        if r.random() < 0.1:
            family += "-" + r.choice(self.family)
        elif r.random() < 0.1:
            family = r.choice(["van ", "de la ", "von ", "de ", "van der "]) + family
        given = self._pick(self.given, self.pool_given, level if r.random() < 0.8 else LISTED)
        if family_only:
            return family
        k = r.random()
        if k < 0.5:
            text = f"{given} {family}"
        elif k < 0.65:
            text = f"{family}, {given}"
        elif k < 0.8:
            text = f"{r.choice('ABCDEFGHJKLMNOPRSTVWY')}. {family}"
        else:
            text = f"{given} {r.choice('ABCDEFGHJKLMNOPRSTVWY')}. {family}"
        k = r.random()
        if ". " not in text:
            text = text.upper() if k < 0.1 else text.lower() if k < 0.2 and level != UNKNOWN else text
        return text

    def email(self) -> str:
        r = self.rng
        g, f = r.choice(self.given).lower(), r.choice(self.family).lower()
        local = r.choice([f"{g}.{f}", f"{g[0]}{f}", f"{f}{r.randint(0, 9)}", f"{g}_{r.randint(10, 99)}", f"{g}+set", f"{f}-{g}", f"info.{f}{r.randint(0, 9)}", g + f])
        domain = r.choice([["example", "org"], ["mail", "example", "net"], ["frames", "test"], ["post", "studio", "invalid"], ["work", "example"], ["some-firm", "com"], ["my-shop", "de"], ["example", "com"], ["two-words", "example"]])
        k = r.random()
        if k < 0.7:
            text = local + "@" + ".".join(domain)
        elif k < 0.8:
            text = local + " at " + " dot ".join(domain)
        elif k < 0.9:
            text = local + " [at] " + " [dot] ".join(domain)
        else:
            text = local + " (at) " + ".".join(domain)
        return text.upper() if r.random() < 0.08 else text

    def phone(self) -> str:
        shapes = ["415-555-0199", "(415) 555-0199", "415.555.0199", "415 555 0199", "4155550199", "+1 415 555 0199", "1-415-555-0199", "+44 20 7946 0999", "020 7946 0999", "+44 7700 900 999", "07700 900999", "+33 1 99 00 99 99", "01 99 00 99 99", "+49 30 23125-999", "0049-30-23125999", "030 23125 999", "030 23125-999", "+34 919 999 999", "0999/999999"]
        text = re.sub(r"9", lambda _: str(self.rng.randint(0, 9)), self.rng.choice(shapes))
        if self.rng.random() < 0.5 and not text.startswith(("0", "+", "(0")):
            text = re.sub("415", self.rng.choice(["206", "312", "617", "719", "415"]), text, count=1)
        return text.replace(" ", " ") if self.rng.random() < 0.1 else text

    def identity(self) -> str:
        letter = self.rng.choice("ABFGKMQRTWYZ")
        shape = self.rng.choice(["999-99-9999", "999 99 9999", "999999999", f"99999999-{letter}", f"99999999{letter}", f"99999999 {letter}", f"Z{letter}9999999", f"{letter}-999.999.999", f"XX 99 99 99 {letter}", f"XX999999{letter}", f"{letter}99999999", f"X9999999{letter}", f"{letter}{letter}-9999999"])
        text = _digits(self.rng, shape)
        return text.lower() if self.rng.random() < 0.05 else text

    def address(self) -> str:
        r = self.rng
        number = r.choice([str(r.randint(1, 240)), f"{r.randint(1, 240)}{r.choice('ABC')}", f"{(k := r.randint(1, 200))}-{k + 2}"])
        text = f"{number} {r.choice(_STREET_NAMES)} {r.choice('Street Street St. Avenue Ave Road Road Rd Lane Court Terrace Mews Blvd Boulevard Drive Square Crescent Grove Gardens'.split())}"
        if r.random() < 0.12:
            text = f"{number} {self._family()} {r.choice('Street Road Avenue Lane Grove Walk'.split())}"
        k = r.random()
        return text.upper() if k < 0.12 else text.lower() if k < 0.2 else text

    def german(self) -> str:
        r = self.rng
        if r.random() < 0.15:
            return r.choice(["Am Alten Markt", "Am Graben", "Unter den Linden", "An der Kirche", "Am Stadtpark", "Im Hof", "Hinter dem Tor", "Am Mühlbach"]) + f" {r.randint(1, 240)}" + r.choice(["", "", "b"])
        stem = r.choice(["Eichen", "Schul", "Wiesen", "Kirch", "Neu", "Tal"]) if r.random() < 0.6 else self._family()
        return stem + r.choice(["straße", "str.", "weg", "-Allee", "gasse", "platz"]) + f" {r.randint(1, 240)}" + r.choice(["", "", "a"])

    def spanish(self) -> str:
        r = self.rng
        return r.choice(["Calle", "C/", "Avenida de", "Avda.", "Paseo de"]) + f" {r.choice(_STREET_NAMES).replace('St. ', '')}{r.choice(['', '', ','])} {r.randint(1, 240)}"

    def french(self) -> str:
        r = self.rng
        return f"{r.randint(1, 240)}{r.choice(['', ' bis', ',', ' bis,'])} {r.choice(['rue de', 'avenue', 'boulevard', 'chemin de', 'rue'])} {r.choice(_STREET_NAMES)}"

    def sentence(self) -> tuple[str, list[tuple[int, int, int]]]:
        """A sentence and its entities (start, end, kind)."""
        r = self.rng
        slot = r.choice(r.choices([_NAME_SLOTS, _OTHER_SLOTS, _DECOYS], [5, 4, 4])[0])
        make = {"n": (0, self.name), "f": (0, lambda: self.name(True)), "e": (1, self.email), "p": (2, self.phone), "i": (3, self.identity), "a": (4, self.address), "d": (4, self.german), "s": (4, self.spanish), "r": (4, self.french)}
        text, gold = "", []
        for piece in re.split(r"(\{[^{}]*\})", slot):
            if len(piece) > 2 and piece[0] == "{":
                key = piece[1:-1]
                if key in make:
                    kind, maker = make[key]
                    value = maker()
                    gold.append((len(text), len(text) + len(value), kind))
                elif key == "v":
                    value = r.choice(_VERBS)
                elif key == "w":
                    value = r.choice(_THINGS) if r.random() < 0.5 else self._given().lower()
                elif key == "U":
                    value = r.choice([self._given, self._family])()
                elif key == "C":
                    value = r.choice("ABCDEFGH")
                elif key.upper() == "G":
                    value = r.choice(self.given)
                    value = value.lower() if key == "g" else value
                else:
                    value = _digits(r, key)
                text += value
            else:  # some words are invented, so that no sentence is learned by heart
                text += re.sub(r"\b[a-zà-ÿ]{3,}\b", lambda m: self._given().lower() if m.group() not in TITLES and r.random() < 0.12 else m.group(), piece)
        return text, gold

    def document(self) -> tuple[str, set[tuple[int, int, int]]]:
        text, gold = "", set()
        for _ in range(self.rng.randint(1, 3)):
            if text:
                text += self.rng.choice([" ", " ", "\n", "\n\n"])
            more, found = self.sentence()
            if self.rng.random() < (0.08 if found else 0.25) and len(more.upper()) == len(more):
                more = more.upper()
            gold |= {(a + len(text), b + len(text), k) for a, b, k in found}
            text += more
        return text, gold


def train_field(names: list[tuple[str, str]], documents: int = 12000, seed: int = 13) -> np.ndarray:
    """Weights from generated documents. Where no form ends as the entity does, the one that ends nearest stands for it."""
    maker = Sentences(names, seed)
    lexicon = maker.lexicon()
    samples = []
    for k in range(documents):
        text, gold = maker.document()
        segments = Finder(lexicon).segments(text)
        have = {(s.start, s.end, s.kind) for s in segments}
        exact = set()
        for a, b, kind in gold:
            near = sorted((abs(e - b), s, e, k2) for s, e, k2 in have if k2 == kind and s == a)
            if near:
                exact.add(near[0][1:])
        samples.append((segments, exact))
    return fit_field(samples)


_GAP = re.compile(r"[ \t ]{1,3}")
_COMMA = re.compile(r",[ \t ]{1,3}")
_INITIAL = re.compile(r"\.[ \t ]{0,3}")


class Finder:
    """Possible entities of a text, with their features."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon

    def segments(self, text: str, only_names: bool = False) -> list[Segment]:
        out: list[Segment] = []
        if only_names:
            self._names(out, text)
            return out
        if "@" in text or "at" in text or "AT" in text:
            for m in _EMAIL.finditer(text):
                self._add(out, text, m.start(), m.end(), 1, _email_features(text, m.start(), m.end()))
        for m in _DIGITS.finditer(text):
            self._numbers(out, text, m.start(), m.end(), 2)
        spans = {m.span() for form in _IDENTITY for m in form.finditer(text) if sum(c.isdigit() for c in m.group()) >= 6}
        for a, b in sorted(spans):
            self._add(out, text, a, b, 3, _number_features(text, 3, a, b))
        for form, pattern in _ADDRESS:
            if form in _NEEDS and not _NEEDS[form].search(text):
                continue
            at = 0
            while m := pattern.search(text, at):
                self._add(out, text, m.start(), m.end(), 4, _address_features(text, form, m.start(), m.end()))
                at = m.start() + 1 if m.start() + 1 > at else at + 1
                at = max(at, m.start() + max(1, len(re.match(r"\S*", text[m.start() :]).group())))
        self._names(out, text)
        return out

    def _add(self, out: list[Segment], text: str, start: int, end: int, kind: int, features: list[str], words: tuple[str, str] = ("", "")) -> None:
        if 0 < end - start <= MAX_SPAN:
            out.append(Segment(start, end, kind, [_hash(kind, f) for f in ["bias", *features, *_context(text, start, end)]], words))

    def _numbers(self, out: list[Segment], text: str, start: int, end: int, kind: int) -> None:
        """The whole run of digit groups, and its parts if it is long enough to hold two numbers."""
        groups = [(m.start() + start, m.end() + start) for m in re.finditer(r"[+(]?\d+\)?", text[start:end])]
        digits = [sum(c.isdigit() for c in text[a:b]) for a, b in groups]
        bounds = {(start, end)} if 7 <= sum(digits) <= 15 else set()
        for i in range(len(groups) if sum(digits) > 11 else 0):
            j, total = i, 0
            while j < len(groups) and (total := total + digits[j]) <= 15:
                first, last = groups[i][0], groups[j][1]
                # numbers that run together have a blank between them; a part of a decimal or of a dashed number is none
                if total >= 7 and (first == start or text[first - 1].isspace()) and (last == end or text[last].isspace()):
                    bounds.add((first, last))
                j += 1
        for a, b in sorted(bounds):
            self._add(out, text, a, b, kind, _number_features(text, kind, a, b))

    def _names(self, out: list[Segment], text: str) -> None:
        lex, given, family = self.lexicon, self.lexicon.given, self.lexicon.family
        spans = [(m.start(), m.end(), m.group()) for m in _TOKEN.finditer(text)]
        low = [w.lower() if w.isascii() else _repaired(w) for _, _, w in spans]
        n = len(spans)
        seen: set[tuple[int, int]] = set()

        def gap(i: int, pattern: re.Pattern) -> bool:
            return i + 1 < n and pattern.fullmatch(text, spans[i][1], spans[i + 1][0]) is not None

        def family_end(i: int) -> int | None:
            """Place of the family's last word if a family name, with its particles, can start at word i."""
            while i < n and low[i] in PARTICLES and gap(i, _GAP):
                i += 1
            return i if i < n and len(low[i]) > 1 and low[i] not in PARTICLES else None

        def add(i: int, j: int, form: str, g: int | None, f: int, first_family: int) -> None:
            start, end = spans[i][0], spans[j][1]
            if (start, end) in seen:
                return
            gs = lex.given_status(low[g]) if g is not None else "-"
            fs = lex.family_status(low[f])
            particle = first_family != f
            if start and text[start - 1].isdigit():  # the letter of a house number or a flat
                return
            if (low[f] in COMMON and fs == UNKNOWN) or (g is not None and low[g] in COMMON and gs == UNKNOWN):
                return
            gc, fc = _cased(spans[g][2]) if g is not None else "-", _cased(spans[f][2])
            titled = i > 0 and low[i - 1] in TITLES
            if g is not None and (gc == "l") != (fc == "l") and (form == "F,G" or (gs == fs == UNKNOWN and not titled)):
                return
            seen.add((start, end))
            known = "both" if gs in "KL" and fs in "KL" else "family" if fs in "KL" else "given" if gs in "KL" else "none"
            before = text[max(0, start - 2) : start]
            features = [
                f"known {known}", f"form {form} known {known}", f"case {gc}{fc}", f"case {gc}{fc} known {known}", f"form {form} {gc}{fc}", f"particle {particle} {known}", f"title {titled}",
                f"hyphen {'-' in spans[f][2]} {known}", f"begin {before.strip() == '' and (start == 0 or chr(10) in before)} {known}", f"len {min(len(spans[f][2]), 4)}", f"inner {j - i}",
            ]
            near = [spans[k][2] for k in (i - 2, i - 1, j + 1, j + 2) if 0 <= k < n and len(spans[k][2]) > 1]
            loud = bool(near) and all(w.isupper() for w in near)  # among capitals a word in capitals says nothing
            features += [f"loud {loud} {gc}{fc} {known}"] + [f"{c} {known}" for c in _context(text, start, end)[:3]]
            self._add(out, text, start, end, 0, features, (low[g] if g is not None else "", low[f]))

        for i in range(n):
            word = low[i]
            cased = spans[i][2][0].isupper()
            if not cased and len(word) > 1 and word not in given and word not in family and word not in PARTICLES and "-" not in word:
                if not (i + 1 < n and low[i + 1] in family) and not (i and low[i - 1] in TITLES):
                    continue
            if len(word) == 1:  # initial and family
                if gap(i, _INITIAL) and (e := family_end(i + 1)) is not None:
                    if lex.family_status(low[e]) != UNKNOWN or (cased and spans[e][2][0].isupper()):
                        add(i, e, "IF", None, e, i + 1)
                continue
            if i and low[i - 1] in TITLES and re.fullmatch(r"\.?[ \t ]{1,3}", text[spans[i - 1][1] : spans[i][0]]) and (e := family_end(i)) is not None:
                add(i, e, "TF", None, e, i)
            start_given = word in given or cased
            if start_given or (cased and word not in PARTICLES) or (i + 1 < n and low[i + 1] in family):
                k = i
                form = "GF"
                if gap(k, _GAP) and len(low[k + 1]) == 1 and gap(k + 1, _INITIAL):
                    k, form = k + 1, "GIF"
                if (gap(k, _GAP) or form == "GIF") and word not in TITLES and (e := family_end(k + 1)) is not None:
                    if start_given or lex.family_status(low[e]) != UNKNOWN:
                        add(i, e, form, i, e, k + 1)
            if cased or word in family or "-" in word or word in PARTICLES:  # family, given
                e = family_end(i)
                if e is not None and gap(e, _COMMA) and e + 1 < n and len(low[e + 1]) > 1:
                    gs, fs = lex.given_status(low[e + 1]), lex.family_status(low[e])
                    if (gs != UNKNOWN or fs != UNKNOWN) or (cased and spans[e + 1][2][0].isupper()):
                        add(i, e + 1, "F,G", e + 1, e, i)


# ---- field -------------------------------------------------------------------------------------


def _lattice(segments: list[Segment]) -> tuple[list[int], list[list[int]]]:
    """Sorted bounds and, for each bound, the segments that end there."""
    bounds = sorted({b for s in segments for b in (s.start, s.end)})
    place = {b: i for i, b in enumerate(bounds)}
    ending: list[list[int]] = [[] for _ in bounds]
    for k, s in enumerate(segments):
        ending[place[s.end]].append(k)
    return bounds, ending


def marginals(segments: list[Segment], scores: list[float]) -> list[float]:
    """Probability of each segment under the field: forward and backward sums over the bounds."""
    bounds, ending = _lattice(segments)
    place = {b: i for i, b in enumerate(bounds)}
    n = len(bounds)

    def add(a: float, b: float) -> float:
        high, low = (a, b) if a > b else (b, a)
        return high + math.log1p(math.exp(low - high)) if low > -1e18 else high

    forward = [0.0] * n
    for i in range(n):
        total = forward[i - 1] if i else 0.0
        for k in ending[i]:
            total = add(total, forward[place[segments[k].start]] + scores[k])
        forward[i] = total
    backward = [0.0] * n
    starting: list[list[int]] = [[] for _ in bounds]
    for k, s in enumerate(segments):
        starting[place[s.start]].append(k)
    for i in range(n - 1, -1, -1):
        total = backward[i + 1] if i + 1 < n else 0.0
        for k in starting[i]:
            total = add(total, backward[place[segments[k].end]] + scores[k])
        backward[i] = total
    whole = forward[-1] if n else 0.0
    return [math.exp(min(0.0, forward[place[s.start]] + scores[k] + backward[place[s.end]] - whole)) for k, s in enumerate(segments)]


def best_labelling(segments: list[Segment], scores: list[float]) -> list[int]:
    """The set of segments that don't overlap with the largest total score."""
    bounds, ending = _lattice(segments)
    place = {b: i for i, b in enumerate(bounds)}
    best, took = [0.0] * len(bounds), [-1] * len(bounds)
    for i in range(len(bounds)):
        best[i] = best[i - 1] if i else 0.0
        for k in ending[i]:
            if (value := best[place[segments[k].start]] + scores[k]) > best[i]:
                best[i], took[i] = value, k
    chosen, i = [], len(bounds) - 1
    while i >= 0:
        if took[i] >= 0:
            chosen.append(took[i])
            i = place[segments[took[i]].start]
        else:
            i -= 1
    return chosen[::-1]


def fit_field(samples: list[tuple[list[Segment], set[tuple[int, int, int]]]], epochs: int = 6, rate: float = 0.25) -> np.ndarray:
    """Weights by stochastic gradient on the field's likelihood, with AdaGrad and weight decay."""
    weights, squares = np.zeros(HASH_SIZE), np.full(HASH_SIZE, 1e-2)
    rng = random.Random(7)
    samples = [s for s in samples if s[0]]
    for _ in range(epochs):
        rng.shuffle(samples)
        for segments, gold in samples:
            scores = [float(weights[s.features].sum()) for s in segments]
            probable = marginals(segments, scores)
            for s, p in zip(segments, probable):
                g = (1.0 if (s.start, s.end, s.kind) in gold else 0.0) - p
                if abs(g) > 1e-3:
                    squares[s.features] += g * g
                    weights[s.features] += rate * (g - 1e-3 * weights[s.features]) / np.sqrt(squares[s.features])
    return weights


def entities(text: str, finder: Finder, weights: np.ndarray) -> list[Segment]:
    """The entities of a text by the best joint labelling, in order."""
    segments = finder.segments(text)
    if not segments:
        return []
    scores = [float(weights[s.features].sum()) for s in segments]
    return [segments[k] for k in best_labelling(segments, scores)]


# ---- operators ---------------------------------------------------------------------------------


WORDS = "role string, word string, status string"
#: Listed names that training sentences are made with, at most.
TRAINING_NAMES = 20_000


def listed_words(names: DataFrame) -> DataFrame:
    """``role`` (g or f), ``word`` and ``status`` of the listed names, in lower case; null names are left out."""
    rows = names.select("given_name", "family_name").where("given_name is not null and family_name is not null")
    both = rows.select(F.lit("g").alias("role"), F.lower("given_name").alias("word")).unionByName(rows.select(F.lit("f").alias("role"), F.lower("family_name").alias("word")))
    return both.distinct().select("role", "word", F.lit(LISTED).alias("status"))


def training_names(names: DataFrame) -> list[tuple[str, str]]:
    """The listed names, or as many as ``TRAINING_NAMES`` of them by the order of a hash."""
    rows = names.select("given_name", "family_name").where("given_name is not null and family_name is not null").distinct()
    few = rows.orderBy(F.xxhash64("given_name", "family_name"), "given_name", "family_name").limit(TRAINING_NAMES)
    return sorted((r["given_name"], r["family_name"]) for r in few.collect())


def _tokens(text: str) -> set[str]:
    low = {_repaired(m.group()) for m in _TOKEN.finditer(text)}
    return low | {part for w in low if "-" in w for part in w.split("-")}


def with_known_words(documents: DataFrame, words: DataFrame) -> tuple[DataFrame, Lexicon | None]:
    """``doc_id``, ``text`` and ``known``, spread over the cores, and the lexicon if it is small enough to broadcast.

    A lexicon of more than ``LEXICON_WORDS`` words is joined with the documents' words instead,
    and each document carries its own few in ``known``.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    few = words.limit(LEXICON_WORDS + 1).collect()
    if len(few) <= LEXICON_WORDS:
        return spread(rows.withColumn("known", F.lit(None).cast(f"array<struct<{WORDS}>>"))), Lexicon.of([tuple(r) for r in few])
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "texts")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = sorted(_tokens(text.as_py()))
                yield pa.RecordBatch.from_pydict({"row": pa.array([key] * len(found), pa.int64()), "word": pa.array(found, pa.string())})

    used = spread(rows.select("row", "text").where("text is not null")).mapInArrow(split, "row long, word string")
    own = used.join(words, "word").groupBy("row").agg(F.collect_list(F.struct("role", "word", "status")).alias("known"))
    return rows.join(own, "row", "left").select("doc_id", "text", "known"), None


def learned_words(documents: DataFrame, listed: DataFrame, weights: np.ndarray, least_documents: int = 3) -> DataFrame:
    """Words that all documents together show to be names, as ``listed_words``.

    A first pass over the whole corpus scores every possible name whose words are
    both capitalised. A word joins as a given or family name if at least
    ``least_documents`` documents have it so with a probability of 0.8 or more, and
    these are most of its capitalised uses beside another possible name word. Counts are
    summed on the executors. The words are a feature of the second pass only: there a name
    is found wherever it occurs.
    """
    rows, lexicon = with_known_words(documents.where("text is not null"), listed)
    shared = documents.sparkSession.sparkContext.broadcast((lexicon, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, w = shared.value
        sure, all_uses = Counter(), Counter()
        for batch in batches:
            for value, known in zip(batch.column(0), batch.column(1)):
                text, lexicon = value.as_py(), common or _own(known)
                segments = Finder(lexicon).segments(text, only_names=True)
                if not segments:
                    continue
                scores = [float(w[s.features].sum()) for s in segments]
                uses: dict[tuple[str, str], float] = {}
                for s, p in zip(segments, marginals(segments, scores)):
                    if not text[s.start : s.end].isupper():  # in capitals any word looks like a name
                        for role, word, have in (("g", s.words[0], lexicon.given), ("f", s.words[1], lexicon.family)):
                            if word and word not in have and len(word) > 2:
                                uses[role, word] = max(p, uses.get((role, word), 0.0))
                for key, p in uses.items():
                    all_uses[key] += 1
                    sure[key] += p >= 0.8
        keys = list(all_uses)
        yield pa.RecordBatch.from_pydict({"role": pa.array([k[0] for k in keys], pa.string()), "word": pa.array([k[1] for k in keys], pa.string()), "sure": pa.array([sure[k] for k in keys], pa.int64()), "uses": pa.array([all_uses[k] for k in keys], pa.int64())})

    counts = rows.select("text", "known").mapInArrow(run, "role string, word string, sure long, uses long").groupBy("role", "word").agg(F.sum("sure").alias("sure"), F.sum("uses").alias("uses"))
    return counts.where((F.col("sure") >= least_documents) & (F.col("sure") * 2 >= F.col("uses"))).select("role", "word", F.lit(LEARNED).alias("status"))


def _own(known: pa.Scalar) -> Lexicon:
    return Lexicon.of([(k["role"], k["word"], k["status"]) for k in known.as_py() or []])


def _labelled(documents: DataFrame, names: DataFrame, work, schema: str) -> DataFrame:
    """Applies ``work(key, text, entities or None for a null text)``, which gives rows, to all documents."""
    weights = train_field(training_names(names))
    listed = listed_words(names)
    words = materialize(listed.unionByName(learned_words(documents, listed, weights)), "name-words")
    rows, lexicon = with_known_words(documents, words)
    shared = documents.sparkSession.sparkContext.broadcast((lexicon, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, w = shared.value
        finder = Finder(common) if common is not None else None
        for batch in batches:
            out = []
            for key, value, known in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                text = value.as_py()
                out += work(key, text, None if text is None else entities(text, finder or Finder(_own(known)), w))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=columns)

    columns = [c.split()[0] for c in schema.split(", ")]
    types = [{"long": pa.int64(), "string": pa.string(), "int": pa.int32()}[c.split()[1]] for c in schema.split(", ")]
    return rows.mapInArrow(run, schema)


def find_personal(documents: DataFrame, names: DataFrame) -> DataFrame:
    """``doc_id``, ``kind`` and ``start_pos`` (characters, from 1) of each item of personal information.

    ``documents`` has ``doc_id`` and ``text``, ``names`` (a list of known people, may be
    empty, of any length) ``given_name`` and ``family_name``. Null, empty and blank texts have no
    items, nor has a null id; texts are read whole; repeated rows count once; empty
    documents give no rows. Other columns are ignored.
    """
    rows = documents.where("doc_id is not null and text is not null")
    return _labelled(rows, names, lambda key, _, found: [(key, KINDS[s.kind], s.start + 1) for s in found], "doc_id long, kind string, start_pos int").distinct()


def replace_entities(text: str, found: list[Segment]) -> str:
    """Text with ``[KIND]`` in place of each entity."""
    out, at = [], 0
    for s in found:
        out += [text[at : s.start], f"[{KINDS[s.kind].upper()}]"]
        at = s.end
    return "".join([*out, text[at:]])


def redact_personal(documents: DataFrame, names: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` with typed placeholders; every row, a null text stays null."""
    return _labelled(documents, names, lambda key, text, found: [(key, None if text is None else replace_entities(text, found))], "doc_id long, text string")
