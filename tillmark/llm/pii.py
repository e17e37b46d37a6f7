"""Personal data by offset-preserving deobfuscation.

Identifiers are first sought in a text as it stands (the base spans). Then four transducers
rewrite it, each keeping for every piece where it came from: look-alike and compatibility
characters become ASCII and invisible ones vanish; runs of spelled digits become digits; "at" and
"dot" in brackets, then bare ones inside of addresses, become @ and full stops. The same detectors run on the result, and what they
find is mapped back to the source and added, unless a base span of its kind covers it.

All passes are linear in the text's length. Spans count code points, ends exclusive.

Defined cases: a null text is as an empty one. Base spans of different kinds may overlap. Very long
texts are searched whole. Repeated rows give repeated rows, an empty table none. Other columns, whatever
their names, stay as they are.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.batches import bounded, extended, pieces, strings

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# ---- detectors -------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
_NUMBER = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){11,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Goes from one @ to the next and back to the start of the local part, which gives the
    matches of the leftmost search without trying every start of a long word."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        else:
            free = at + 1
        at = text.find("@", free)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers at a time of each dotted chain, if all are at most 255."""
    for chain in _DOTTED.finditer(text):
        parts = list(_NUMBER.finditer(text, chain.start(), chain.end()))
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            if all(_byte(p.group()) for p in four):
                yield four[0].start(), four[3].end()


def _byte(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 3 or len(digits) == 3 and digits <= "255"


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("+")
    while at >= 0:
        m = _PHONE.match(text, at)
        if m and 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()
        at = text.find("+", m.end() if m else at + 1)


DETECTORS = dict(zip(KINDS, (emails, addresses, cards, phones)))


def detect(text: str) -> list[Span]:
    return [(kind, *span) for kind, found in DETECTORS.items() for span in found(text)]


# ---- transducers -----------------------------------------------------------------------------


class Rewritten:
    """A text after replacements, and the way back."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        """edits: (start, stop, replacement) in order, apart from one another."""
        out, place, at = [], 0, 0
        self.begins: list[int] = []  # of the pieces, in the new text; none is empty
        self.sources: list[tuple[int, int, bool]] = []  # start, stop, unchanged

        def piece(content: str, start: int, stop: int, same: bool) -> None:
            nonlocal place
            if content:
                out.append(content)
                self.begins.append(place)
                self.sources.append((start, stop, same))
                place += len(content)

        for start, stop, new in edits:
            piece(text[at:start], at, start, True)
            piece(new, start, stop, False)
            at = stop
        piece(text[at:], at, len(text), True)
        self.text = "".join(out)

    def back(self, start: int, stop: int) -> tuple[int, int]:
        """The source of new[start:stop], which must not be empty."""
        first, last = (bisect_right(self.begins, i) - 1 for i in (start, stop - 1))
        a, _, same = self.sources[first]
        if same:
            a += start - self.begins[first]
        b, end, same = self.sources[last]
        return a, b + stop - self.begins[last] if same else end


# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j",
    "ѕ": "s", "ԁ": "d", "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w", "в": "b", "к": "k", "м": "m",
    "т": "t", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P",
    "С": "C", "Т": "T", "Х": "X", "У": "Y", "І": "I", "Ј": "J", "Ѕ": "S", "З": "3",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "υ": "u", "τ": "t",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "․": ".", "。": ".",
    "·": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
}
# Soft hyphen, zero-width characters, word joiner, byte order mark.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
# Also no-break and typographic spaces, super- and subscript, Arabic, Persian, Devanagari, circled
# and fullwidth digits, fullwidth ASCII, and mathematical letters and digits.
_FOREIGN = re.compile(
    "[" + INVISIBLE + "".join(LOOK_ALIKES)
    + "\u00a0\u00b2\u00b3\u00b9\u0660-\u0669\u06f0-\u06f9\u0966-\u096f\u2000-\u200a\u202f\u205f"
    "\u2070-\u2079\u2080-\u2089\u2460-\u2468\u3000\uff01-\uff5e\U0001d400-\U0001d7ff]"
)


def plain_character(c: str) -> str:
    """ASCII for a look-alike, a compatibility form or a foreign digit; nothing for the invisible;
    else the character itself."""
    if c in INVISIBLE:
        return ""
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    form = unicodedata.normalize("NFKC", c)
    return form if len(form) == 1 and form.isascii() else c


def homoglyphs(text: str) -> list[tuple[int, int, str]]:
    found = ((m.start(), m.end(), m.group()) for m in _FOREIGN.finditer(text))
    return [(a, b, new) for a, b, c in found if (new := plain_character(c)) != c]


# Names of the digits in English, French, German and Spanish, and of the plus sign.
DIGIT_WORDS = {
    name: digit for digit, names in {
        "0": "zero oh zéro null cero", "1": "one un une eins ein uno una", "2": "two deux zwei zwo dos",
        "3": "three trois drei tres", "4": "four quatre vier cuatro", "5": "five cinq fünf fuenf cinco",
        "6": "six sechs seis", "7": "seven sept sieben siete", "8": "eight huit acht ocho",
        "9": "nine neuf neun nueve",
    }.items() for name in names.split()
}
PLUS_WORDS = ("plus", "más", "mas")
_NAME = "(?:" + "|".join([*DIGIT_WORDS, *PLUS_WORDS]) + ")"
_SPELLED = re.compile(
    rf"(?i)(?<![\w+])(?:{_NAME}|[0-9+]++)(?:[ ,-]{{1,2}}(?:{_NAME}|[0-9]++))+(?!\w)"
)
_TOKEN = re.compile(r"[^\W\d_]+|[0-9+]+")
_ENDS, _BEGINS = re.compile(rf"(?:{_NAME}|[0-9+])\Z"), re.compile(rf"{_NAME}|[0-9+]")
_UNFOLDED = re.compile("[\u017f\u0130\u0131\u212a]")  # equal ASCII without case, but not in lower case
LEAST_SPELLED = 3  # digit words in a run; fewer are prose


def _may_be_spelled(text: str) -> bool:
    """Whether there may be a run of three digit words; cheap, as "un", "dos" and "six" are in all prose.

    A run's words lie between separators, but for the first and the last, which other signs may touch. So
    one of three digit words is a word of its own, between two that end and begin as a run does.
    """
    if _UNFOLDED.search(text):
        return True
    words = text.lower().replace(",", " ").replace("-", " ").split()
    if DIGIT_WORDS.keys().isdisjoint(words):
        return False
    last = len(words) - 1
    return any(
        0 < i < last and _ENDS.search(words[i - 1]) and _BEGINS.match(words[i + 1])
        for i, word in enumerate(words) if word in DIGIT_WORDS
    )


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    """Runs of digit words, mixed with digits or not; "plus" is a plus sign."""
    if not _may_be_spelled(text):
        return []
    edits = []
    for run in _SPELLED.finditer(text):
        tokens = list(_TOKEN.finditer(text, run.start(), run.end()))
        if sum(t.group().lower() in DIGIT_WORDS for t in tokens) < LEAST_SPELLED:
            continue
        for i, token in enumerate(tokens):
            word = token.group().lower()
            new = "+" if word in PLUS_WORDS else DIGIT_WORDS.get(word, word)
            # With the separator after it, so that the digits meet.
            stop = tokens[i + 1].start() if i + 1 < len(tokens) else token.end()
            edits.append((token.start(), stop, new))
    return edits


# How an at sign or a full stop is written out.
_AT = r"\s?[\[({<]\s?(?:at|@)\s?[\])}>]\s?"
_DOT = r"\s?[\[({<]\s?(?:dot|punkt|punto|point|\.)\s?[\])}>]\s?"
_BRACKETED = re.compile(rf"(?i)(?P<at>{_AT})|(?P<dot>{_DOT})")
# Domain endings that are no common words, for addresses written as words.
_ENDINGS = (
    "(?:com|org|net|edu|gov|mil|info|biz|io|co|uk|eu|us|ca|au|de|fr|es|ch|nl|pl|pt|ru|jp|cn|br"
    "|ar|bg|cl|cz|dk|ee|fi|gr|hk|hr|hu|ie|il|ir|kr|kz|lt|lu|lv|mx|nz|ph|ro|rs|sg|sk|th|tr|tw|ua|vn|za"
    "|aero|coop|mobi|museum|xyz|dev|app|example)"
)
_LABELS = r"(?:[a-z0-9-]{1,63}(?: dot |\.)){1,8}"
# "Meet us at example.com" is prose: a bare "at" needs a spoken dot.
_SPOKEN_MAIL = re.compile(
    rf"(?i)[a-z0-9_%+-](?: at (?=[a-z0-9.-]* dot )| @ |@){_LABELS}{_ENDINGS}\b"
)
_SPOKEN_DOT = re.compile(r"(?i) dot ")
_SPOKEN_IP = re.compile(r"(?i)\b[0-9]{1,3}(?: dot [0-9]{1,3}){3}\b")


def bracketed(text: str) -> list[tuple[int, int, str]]:
    """[at], (dot) and the like anywhere."""
    if not re.search(r"(?i)[\[({<]\s?(?:at|@|dot|punkt|punto|point|\.)", text):
        return []
    return [(m.start(), m.end(), "@" if m["at"] else ".") for m in _BRACKETED.finditer(text)]


def spoken(text: str) -> list[tuple[int, int, str]]:
    """Bare words, only inside what reads as one address."""
    edits = []
    dotted = " dot " in text.lower()
    if dotted or " @ " in text:  # a bare "at" needs a spoken dot as well
        free = 0
        for m in _SPOKEN_MAIL.finditer(text):
            start = m.start() + 1  # of the sign or its disguise
            stop = start + 1
            if text[start] == " ":
                stop = text.index(" ", stop) + 1
                edits.append((start, stop, "@"))
            edits += [(*d.span(), ".") for d in _SPOKEN_DOT.finditer(text, stop, m.end())]
            # The local part goes back over spoken dots.
            at = m.start()
            while at >= free:
                while at > free and text[at - 1] in _LOCAL:
                    at -= 1
                if at - 6 < free or not _SPOKEN_DOT.match(text, at - 5) or text[at - 6] not in _LOCAL:
                    break
                edits.append((at - 5, at, "."))
                at -= 6
            free = m.end()
        for m in _SPOKEN_IP.finditer(text) if dotted else ():
            edits += [(*d.span(), ".") for d in _SPOKEN_DOT.finditer(text, *m.span())]
    out: list[tuple[int, int, str]] = []
    for edit in sorted(set(edits)):
        if not out or edit[0] >= out[-1][1]:
            out.append(edit)
    return out


TRANSDUCERS = (homoglyphs, spelled_digits, bracketed, spoken)


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """What only the rewritten text shows, in places of the source."""
    steps: list[Rewritten] = []
    now = text
    for transducer in TRANSDUCERS:
        edits = transducer(now)
        if edits:
            steps.append(Rewritten(now, edits))
            now = steps[-1].text
    if not steps:
        return []
    taken = {kind: sorted(s[1:] for s in base if s[0] == kind) for kind in KINDS}
    out = []
    for kind, start, stop in detect(now):
        for step in reversed(steps):
            start, stop = step.back(start, stop)
        near = taken[kind]
        # Base spans of a kind lie apart, so the last to begin by here is the only one to cover it.
        i = bisect_right(near, (start, len(text)))
        if i == 0 or near[i - 1][1] < stop:
            out.append((kind, start, stop))
    return out


# ---- the operator ----------------------------------------------------------------------------

_SPANS = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_()),
]))
SPANS = "array<struct<kind:string,start:bigint,stop:bigint,base:boolean>>"


def find(text: str) -> list[dict]:
    """All spans by start, then kind as listed, then end."""
    base = detect(text)
    both = [(s, True) for s in base] + [(s, False) for s in added_spans(text, base)]
    both.sort(key=lambda x: (x[0][1], KINDS.index(x[0][0]), x[0][2]))
    return [{"kind": k, "start": a, "stop": b, "base": is_base} for (k, a, b), is_base in both]


def redacted(text: str, spans: list[dict]) -> str:
    """Each span as its kind in brackets; spans that overlap are one, of the first's kind."""
    merged: list[dict] = []
    for s in spans:
        if merged and s["start"] < merged[-1]["stop"]:
            merged[-1]["stop"] = max(merged[-1]["stop"], s["stop"])
        else:
            merged.append(dict(s))
    return Rewritten(
        text, [(s["start"], s["stop"], f"[{s['kind'].upper()}]") for s in merged]
    ).text


def _found(redact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in pieces(batch, batch["text"]):
                content = strings(texts)
                spans = [find(t) for t in content]
                if redact:
                    texts = pa.array(
                        [redacted(t, s) if s else old.as_py()
                         for t, s, old in zip(content, spans, texts)], pa.string()
                    )
                    out = [rows["row"], texts, pa.array(spans, _SPANS)]
                    yield pa.RecordBatch.from_arrays(out, names=["row", "text", "spans"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [rows["row"], pa.array(spans, _SPANS)], names=["row", "spans"]
                    )

    return run


def _rows(docs: DataFrame, text: str) -> DataFrame:
    bounded(docs.sparkSession)
    return docs.select(
        F.struct(
            F.lit(0).alias("__row"), *[F.col(f"`{c}`") for c in docs.columns if c != text]
        ).alias("row"),
        F.col(f"`{text}`").alias("text"),
    )


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """`row` (the other columns) and `spans` of every text."""
    rows = _rows(docs, text)
    return rows.mapInArrow(_found(False), extended(rows.select("row").schema, f"spans {SPANS}"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind; columns stay as they are."""
    rows = _rows(docs, text)
    found = rows.mapInArrow(_found(True), extended(rows.schema, f"spans {SPANS}"))
    return found.select(
        *[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns]
    )


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
    )


def _is_of(kind: str):
    return lambda span: span["kind"] == kind


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: base spans by kind and as a digest, all spans, and how many were added."""
    found = find_spans(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    base = F.filter("spans", lambda s: s["base"])
    counts = [
        F.size(F.filter(base, _is_of(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS
    ]
    return found.select(
        "row.doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_added"),
    )
