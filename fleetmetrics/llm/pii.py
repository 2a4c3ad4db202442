"""Personal data in texts, also where it is disguised: offset-preserving deobfuscation.

Plain identifiers are found in the text itself. Texts that hold a trace of disguise also run through transducers that
rewrite look-alike letters, invisible characters, escapes, spelled digits and at/dot words, one after another, and
remember for every character they emit which source characters it stands for; identifiers found in what they emit are
mapped back to the source. Blanks may be of any kind and number.
"""

from __future__ import annotations

import bisect
import functools
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmetrics.llm.shared import map_batches, slices, tidy

SLICE_BYTES = 2_000_000
KINDS = ("email", "ip", "card", "phone")

# The base patterns. A run of characters that may stand before @ is delimited by ones that may not, and [0-9]+ in an IP
# must take a whole run of digits; so both are matched without trying every later start in a run anew.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMERIC = re.compile(r"[0-9+][0-9+ ().-]{6,}")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def plain(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of undisguised identifiers, by kind as in KINDS, then start."""
    found: dict[str, list] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] += _emails(text)
    for run in _NUMERIC.finditer(text):
        at, part = run.start(), run.group()
        for m in _IP.finditer(part):
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split(".")):
                found["ip"].append((at + m.start(), at + m.end()))
        for m in _CARD.finditer(part):
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                found["card"].append((at + m.start(), at + m.end()))
        if "+" in part:
            for m in _PHONE.finditer(part):
                if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    found["phone"].append((at + m.start(), at + m.end()))
    return [(k, a, b) for k in KINDS for a, b in found[k]]


# Letters of other scripts that look like ASCII ones.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ӏ": "l", "ո": "n", "ս": "u",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "γ": "y", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɑ": "a", "ɡ": "g", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "β": "b", "ε": "e", "η": "n", "ω": "w", "ѵ": "v", "ԛ": "q", "ԝ": "w", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "٫": ".", "․": ".", "。": ".", "⁺": "+",
}
# Characters that do not show.
INVISIBLE = "­​‌‍‎‏⁠⁡⁢⁣﻿"
# Digits as words (English, German, French, Spanish), and words for the signs.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
AT_WORDS = "at|arroba|arobase|ät"
DOT_WORDS = "dot|punto|point|punkt"
PLUS_WORDS = "plus|más|mas"
#: In prose "at this point in" is no address: "point" goes with the at word of its language, and behind a plain at word stands no article.
_NO_DOT = {"at": ("point",), "ät": ("point",)}
_ARTICLES = frozenset("a an the this that these those my your his her its our their each every any some no which what one".split())


@functools.lru_cache(1)
def _letters() -> tuple[dict[str, str], re.Pattern]:
    """Look-alikes, and by rule every character whose compatibility form is one ASCII letter, digit or sign; and a quick pattern for texts that may hold one."""
    table = {}
    for c in map(chr, [*range(0xA0, 0xD800), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1FC00)]):
        n = unicodedata.normalize("NFKC", c)
        if n != c and len(n) == 1 and "!" <= n <= "~":
            table[c] = n
    for c in map(chr, [*range(0x660, 0xD800), *range(0xF900, 0x20000)]):  # digits of other scripts
        if unicodedata.decimal(c, None) is not None:
            table[c] = str(unicodedata.decimal(c))
    table |= LOOKALIKES | dict.fromkeys(INVISIBLE, "")
    return table, re.compile("[" + "".join(re.escape(c) for c in table if c < "\u0250") + "\u0250-\U0010ffff]")


_DIGITS = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_PART = r"\s,.()\[\]/-"
_WORD_RUN = re.compile(rf"(?i)(?<!\w)(?:(?:{PLUS_WORDS})[\s,-]+)?(?:(?:{_DIGITS}|[0-9]{{1,4}}|{DOT_WORDS})(?!\w)(?:[{_PART}]+|\Z|(?=\W))){{4,}}")
_WORD = re.compile(rf"(?i)(?<!\w)(?:{_DIGITS}|{DOT_WORDS}|{PLUS_WORDS})(?!\w)")
_OPEN, _CLOSE = r"(?<!\s)\s*+[\[({<]\s*+", r"\s*+[\])}>]\s*+"
_SIGN = re.compile(rf"(?i){_OPEN}(?:(?P<at>{AT_WORDS}|@)|(?P<dot>{DOT_WORDS}|\.)|(?P<plus>{PLUS_WORDS}|\+)){_CLOSE}")
#: Between the names of an address stand signs: a word between blanks, a word or sign between marks, a sign between blanks.
_MARKS = r"\s*+[-*_~|=^'\"`]{1,3}\s*+"
_AT = re.compile(rf"(?i)(?<=[a-z0-9_%+-])(?:(?P<word>\s++(?:{AT_WORDS})\s++)|(?P<marked>(?:(?<=[a-z0-9%+])){_MARKS}(?:{AT_WORDS}|@){_MARKS})|(?P<spaced>\s++@\s*+|@\s++))(?=[a-z0-9])")
_DOT = re.compile(rf"(?i)(?:(?P<word>\s++(?:{DOT_WORDS})\s++)|(?P<marked>{_MARKS}(?:{DOT_WORDS}|\.){_MARKS})|(?P<spaced>\s++\.\s++)|\.)(?=[a-z0-9])")
_NAME = re.compile(rf"(?i)[a-z0-9]++(?:-(?!(?:{DOT_WORDS})[-\s])[a-z0-9]++)*+")
#: Names before an at word that dot words join; a local part has 64 characters at most.
_BEFORE = re.compile(rf"(?i)(?:[a-z0-9_%+-]++(?:\s++(?:{DOT_WORDS})\s++|{_MARKS}(?:{DOT_WORDS}){_MARKS}))++[a-z0-9_%+-]++\Z")
_BEFORE_DOT = re.compile(rf"(?i)\s++(?:{DOT_WORDS})\s++|{_MARKS}(?:{DOT_WORDS}){_MARKS}")
_LOCAL_PART = 64
_SPOKEN_DOT = re.compile(rf"(?i)(?<=[A-Za-z0-9-])\s++(?:{DOT_WORDS})\s++(?=[A-Za-z0-9-])")
#: Signs as character references of HTML, and as escapes of addresses of the web.
_REFERENCE = re.compile(r"(?i)&(?:#(?P<dec>0{0,4}[0-9]{2,3})|#x(?P<hex>0{0,4}[0-9a-f]{2})|(?P<name>commat|period|plus));|(?<=[a-z0-9])%(?P<esc>40|2e)(?=[a-z0-9])|%(?P<plus>2b)(?=[0-9])")
_NAMED = {"commat": "@", "period": ".", "plus": "+"}
#: Letters in the place of digits, within what is mostly digits.
_LIKE_DIGITS = re.compile(r"(?<![\w.+])[+]?[0-9OolI](?:[ .-]?[0-9OolI]){6,}(?![\w])")
_FOR_DIGITS = {"O": "0", "o": "0", "l": "1", "I": "1"}
#: Without one of these no transducer changes anything.
_TRACE = re.compile(rf"(?i)[\[({{<]\s*+(?:{AT_WORDS}|@|{DOT_WORDS}|\.|{PLUS_WORDS}|\+)\s*+[\])}}>]")


_NAMES = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
_PARTING = re.compile(r"[\s,]+")


class Normalised:
    """A text rewritten step by step, with the source span of each character."""

    def __init__(self, text: str) -> None:
        self.text, self.starts, self.ends = text, list(range(len(text))), list(range(1, len(text) + 1))

    def rewrite(self, edits: Iterator[tuple[int, int, str]]) -> bool:
        """Replace disjoint (start, end) by the strings given, in order; each new character stands for the whole span."""
        text, starts, ends, at, any_ = [], [], [], 0, False
        for a, b, new in edits:
            any_ = True
            text += [self.text[at:a], new]
            starts += self.starts[at:a] + [self.starts[a]] * len(new)
            ends += self.ends[at:a] + [self.ends[b - 1]] * len(new)
            at = b
        if any_:
            self.text, self.starts, self.ends = "".join([*text, self.text[at:]]), starts + self.starts[at:], ends + self.ends[at:]
        return any_


def _look(n: Normalised) -> Iterator[tuple[int, int, str]]:
    table = _letters()[0]
    if not table.keys().isdisjoint(n.text):
        yield from ((i, i + 1, table[c]) for i, c in enumerate(n.text) if c in table)


def _signs(n: Normalised) -> Iterator[tuple[int, int, str]]:
    for m in _SIGN.finditer(n.text):
        yield m.start(), m.end(), {"at": "@", "dot": ".", "plus": "+"}[m.lastgroup]


def _references(n: Normalised) -> Iterator[tuple[int, int, str]]:
    for m in _REFERENCE.finditer(n.text):
        code = m["hex"] or m["esc"] or m["plus"]
        new = _NAMED[m["name"].lower()] if m["name"] else chr(int(m["dec"]) if m["dec"] else int(code, 16))
        if "!" <= new <= "~":
            yield m.start(), m.end(), new


def _addresses(text: str) -> Iterator[tuple[int, int, str]]:
    """Signs for what stands between the names of an address: after an at, the dots on its right, and dot words on its left.

    A plain at word counts only if a dot behind it is disguised too, as prose has "at example.com"; between marks, or as a
    sign between blanks, it counts with plain dots as well. The last name is letters.
    """
    free = 0
    for at in _AT.finditer(text):
        if at.start() < free:
            continue
        dots, end, last, disguised = [], at.end(), None, False
        spoken = at["word"] and at["word"].strip().lower()
        while name := _NAME.match(text, end):
            if spoken and last is None and name.group().lower() in _ARTICLES:
                break
            end, last = name.end(), name.group()
            dot = _DOT.match(text, end)
            if not dot or not _NAME.match(text, dot.end()) or (spoken and dot["word"] and dot["word"].strip().lower() in _NO_DOT.get(spoken, ())):
                break
            disguised |= dot.group() != "."
            dots.append(dot.span())
            end = dot.end()
        if not dots or (at["word"] and not disguised) or not (last.isalpha() and len(last) > 1):
            continue
        left = _BEFORE.search(text, max(free, at.start() - _LOCAL_PART), at.start())
        if left:
            yield from ((*d.span(), ".") for d in _BEFORE_DOT.finditer(text, left.start(), left.end()))
        yield *at.span(), "@"
        yield from ((a, b, ".") for a, b in dots)
        free = end


def _joined(n: Normalised) -> Iterator[tuple[int, int, str]]:
    yield from _addresses(n.text)


def _like_digits(n: Normalised) -> Iterator[tuple[int, int, str]]:
    for run in _LIKE_DIGITS.finditer(n.text):
        letters = [i for i in range(*run.span()) if n.text[i] in _FOR_DIGITS]
        if letters and 2 * len(letters) < sum(map(str.isdigit, run.group())):
            yield from ((i, i + 1, _FOR_DIGITS[n.text[i]]) for i in letters)


def _spoken_dots(n: Normalised) -> Iterator[tuple[int, int, str]]:
    """Dot words on the right of an @, as far as names joined by dots go."""
    at = n.text.find("@")
    while at >= 0:
        end = at + 1
        while m := _NAMES.match(n.text, end):
            end = m.end()
            if not (d := _SPOKEN_DOT.match(n.text, end)):
                break
            yield d.start(), d.end(), "."
            end = d.end()
        at = n.text.find("@", end)


def _digit_words(n: Normalised) -> Iterator[tuple[int, int, str]]:
    """Digits and signs for their words; white space and commas between those of a run become one plain space, as numbers have it."""
    for run in _WORD_RUN.finditer(n.text):
        end, dotted = run.start(), re.search(rf"(?i)(?<!\w)(?:{DOT_WORDS})(?!\w)", run.group())
        before = False  # whether a digit word ends at ``end``
        for m in _WORD.finditer(n.text, run.start(), run.end()):
            word, (a, b) = m.group().lower(), m.span()
            if word in DIGIT_WORDS:
                if dotted and before and n.text[end:a].isspace():
                    a = end  # digits of one part of an address stand together
                yield from _spaces(n.text, end, a)
                yield a, b, DIGIT_WORDS[word]
            else:  # a sign takes the spaces around it along
                while a > end and n.text[a - 1].isspace():
                    a -= 1
                while b < len(n.text) and n.text[b].isspace():
                    b += 1
                yield from _spaces(n.text, end, a)
                yield a, b, "+" if re.fullmatch(PLUS_WORDS, word) else "."
            end, before = b, word in DIGIT_WORDS
        if end > run.start():
            yield from _spaces(n.text, end, run.start() + len(run.group().rstrip()))


def _spaces(text: str, start: int, end: int) -> Iterator[tuple[int, int, str]]:
    for m in _PARTING.finditer(text, start, max(start, end)):
        if m.group() != " ":
            yield *m.span(), " "


_DOT_SET = frozenset(DOT_WORDS.split("|"))
_RUN_SET = frozenset(DIGIT_WORDS) | _DOT_SET | frozenset(PLUS_WORDS.split("|"))
_WORDS = re.compile(r"\w+")


def _maybe(text: str) -> bool:
    """Whether any transducer may find something to do: true of every text that one of them changes."""
    if not text.isascii() and _letters()[1].search(text) and not _letters()[0].keys().isdisjoint(text) or _TRACE.search(text):
        return True
    if ("&" in text or "%" in text) and _REFERENCE.search(text) or next(_addresses(text), None) or any(_FOR_DIGITS.keys() & set(m.group()) for m in _LIKE_DIGITS.finditer(text)):
        return True
    words = set(_WORDS.findall(text.replace("İ", "i").lower()))  # patterns that ignore case take İ for an i
    if not _DOT_SET.isdisjoint(words) and "@" in text and _SPOKEN_DOT.search(text):
        return True
    return not _RUN_SET.isdisjoint(words) and _WORD_RUN.search(text) is not None


def spans(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) of all personal data, by kind, then start: base ones, and others that disguise hides."""
    base = plain(text)
    if not _maybe(text):
        return [(*s, True) for s in base]
    n = Normalised(text)
    for step in (_references, _look, _signs, _joined, _spoken_dots, _digit_words, _like_digits):
        n.rewrite(step(n))
    # Base spans of a kind are in order and apart, so only the last one that begins at or before a span may hold it.
    starts: dict[str, list[int]] = {k: [a for kind, a, _ in base if kind == k] for k in KINDS}
    ends: dict[str, list[int]] = {k: [b for kind, _, b in base if kind == k] for k in KINDS}
    extra = []
    for kind, a, b in plain(n.text):
        a, b = n.starts[a], n.ends[b - 1]
        i = bisect.bisect_right(starts[kind], a) - 1
        if i < 0 or ends[kind][i] < b:
            extra.append((kind, a, b, False))
    return sorted([*((*s, True) for s in base), *extra], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _arrow(rows: list[list[tuple]]) -> pa.Array:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
    return pa.array([[{"kind": k, "start": a, "end": b, "base": c} for k, a, b, c in row] for row in rows], kind)


SPANS = "array<struct<kind: string, start: bigint, end: bigint, base: boolean>>"


def span_rows(find) -> object:
    """For mapInArrow: ``find`` over the texts in the second column."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                found = _arrow([find(text or "") for text in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), found], ["doc_id", "spans"])

    return run


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans (kind, start, end in code points, end exclusive, base) of e-mail and IP addresses, card and phone numbers.

    ``base`` marks those that stand undisguised. One row a row of ``docs``, repeated ones and null ids included; null and
    empty texts have no spans; other columns are ignored; no rows give none.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(span_rows(spans), f"doc_id long, spans {SPANS}")


def joined(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _masked(text: str | None) -> str | None:
    if text is None:
        return None
    out, at = [], 0
    for kind, a, b, _ in sorted(spans(text), key=lambda s: (s[1], -s[2])):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of personal data, disguised or not, replaced by its kind in brackets; spans that overlap by the first one's. Null stays null; all columns stay."""
    schema = docs.schema

    k = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, k, SLICE_BYTES):
                columns = part.columns
                columns[k] = pa.array([_masked(t) for t in columns[k].to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return map_batches(docs, run, schema)
