"""Per-document text quality statistics, and the kind of text they show.

Each document is read once, as a whole, in Arrow batches, and becomes one row of figures: words,
mean word length, shares of symbols, of lines that end in punctuation and of common words; shares of
repeated lines, paragraphs, sentences and word n-grams; and counts of the units it is made of
(sentences, list items, table rows). Combined rules over these rows, as built-in expressions, separate
natural prose from lists, tables and junk. Nothing is shuffled.

No language is junk for its words. ``COMMON`` holds frequent words of some languages; that a text has
few of them only adds to other evidence: letters that follow each other as in no language, no end of
any sentence, a handful of words over and over, punctuation and capitals inside words.

Words are what white space separates; in scripts that do not separate words each letter counts as
one. A unit is a line, or a sentence where a line holds several. Rows are lines cut into short cells
by one separator; items are bulleted or numbered lines, settings, paths and short lines without
common words. A text is what most of its units are, so a caption, a foreign passage or a few list
lines do not decide.

Cases. Null, empty and blank texts have figures of zero and are of no kind (null). Repeated
documents are each judged. Very long texts are read whole, line by line, in linear time.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent short words of languages in Latin script.
COMMON = frozenset(
    "the a an of to and or that this these in is it its was were not for on with as at by be been are we you i he she they one no but "
    "which from has had have if when will would do does what there some any each our their where another without found between same around two "
    "der die das und ist nicht ein eine den dem des mit von zu auf für sich im wir als auch nach bei war aber haben davon obwohl am ob wurde "
    "le la les un une des du de et est que qui ne pas en dans pour sur par au il nous ce cette plus avons dont a été "
    "el los las una y es no se por con su para como más pero al lo aunque "
    "di che è per non della sono o os da em um uma não do het een van dat op niet zijn met te".split()
)
PLAIN_MARKS = ".,;:!?'\"-()。，、"
END = "。！？；.!?…:;\"'”’»)）】」』"
_SENTENCE = re.compile(r"[.!?…]+[\"'”’»)*_`]*(?:\s+|$)|[。！？]+")
_BULLET = re.compile(r"^\s*(?:>\s*)?(?:[-*+•‣◦▪●·–—»→]\s*(?:\[[ xX✓✗]?\]\s*)?|\(?(?:\d{1,4}|[A-Za-z]|[ivxIVX]{1,5})[.):]\s|\[[ xX✓✗]?\]\s|\d{1,4}\s*[-–]\s)\s*(?=\S)")
_SETTING = re.compile(r"^\s*-{0,2}[\w][\w.\- ]{0,40}?\s*(?:=|:|\.{3}|\s-\s|\s{2,}|\t|→|->)\s*\S")
_FLAG = re.compile(r"^\s*(?:-{1,2}[A-Za-z]\w*|[A-Za-z_]\w*)(?:\s*[=:]\s*|\s+)(?:[-+\d.][\d.eE+\- ]*|yes|no|true|false|on|off)\s*$")
_PATH = re.compile(r"^\s*(?:[\w.~\-]+[/\\])+[\w.\-]+\s*$|^\s*https?://\S+\s*$|^\s*[\w\-]+\.[A-Za-z]{2,5}\s*$")
_RULE = re.compile(r"^[\s|+:=_\-─━═┼┬┴├┤│┌┐└┘]{3,}$")
_CELL_TAG = re.compile(r"</?t(?:able|r|d|h|head|body)\b", re.I)
_NUMBER = re.compile(r"^[-+−]?(?:\d[\d.,]*|\.\d+)(?:[eE][-+]?\d+)?%?$")
_SEPARATORS = ("\t", "|", ";", ",", "~", "  ")
_ROW_MARKS = (" · ", " • ", " | ", " / ", " > ", " » ", " → ", " ~ ", " :: ", ", ", "; ", "\t", "  ")
_TORN = re.compile(r"[^\W\d_][?#�@*$%&][^\W\d_]|^[?#�@*$%&][^\W\d_]")
_INNER = re.compile(r"[^\W\d_][.,?!;:][^\W\d_]")
_CAPS = re.compile(r"[^\W\d_A-ZÀ-ÞА-Я](?=[A-ZÀ-ÞА-Я])")
_MARKS_ON = "\u0300-\u036f\u0591-\u05c7\u064b-\u065f\u0900-\u0dff\u0e31-\u0e4e\u1000-\u109f"
#: The end of a sentence: a mark behind a letter (which may carry marks of its own) and before a blank, or a full
#: stop of a script that sets none. The mark is looked for first, as letters are many.
_STOP = re.compile(r"[.!?…؟۔።։](?:(?<=[^\W\d_].)|(?<=[" + _MARKS_ON + r"].))[.!?…؟۔።։]*[\"'”’»)*_`]*(?:\s|$)")
_FULL_STOP = re.compile("[。！？।॥]")
#: Words of the scripts whose vowels are known here, and runs of letters that no language forms often; l and
#: r count as neither, as they make syllables in some.
_KNOWN = re.compile(r"^(?:[a-zæœøıłđðþß]+|[а-яёіїєґўђћљњџјѓќѕ]+|[α-ω]+)$")
_ROUGH = re.compile(r"[bcdfghjkmnpqstvwxzđðþßбвгґджзйкмнпстфхцчшщђћџјѓќѕβγδζθκμνξπσςτφχψ]{4}|^[lrлрλρ]?[bcdfghjkmnpqstvwxzбвгджзкмнпстфхцчшщβγδζθκμνξπσςτφχψ]+[lrлрλρ]?$|^[b-df-hj-np-tv-xzб-гджзк-нпр-тф-щβ-δζθκ-νξπρ-τφ-ψ]{6}|[aeiouyæœøıаеёиоуыэюяіїєαεηιουω]{4}")
_PARAGRAPH = re.compile(r"\n\s*\n")
_PIECE = re.compile(r"[.!?]\s+|[。！？\n]")


def _wide(c: str) -> bool:
    """Letters of scripts written without blanks."""
    return "぀" <= c <= "ヿ" or "㐀" < c <= "鿿" or "฀" <= c <= "\u0fff" or "\u1000" <= c <= "\u109f" or "\u1780" <= c <= "\u17ff" or "가" <= c <= "힣"


def _plain_letters(word: str) -> str:
    """Letters without their accents."""
    return "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))


@lru_cache(maxsize=1 << 16)
def _traits(word: str) -> tuple[str, int]:
    """The bare word, and bits: common, of letters only, torn, punctuated inside, a capital inside, of four letters or
    more of a known script, rough. At most 65,536 words are remembered, whatever the corpus."""
    b = _bare(word)
    marks = int(b in COMMON) | (bool(_CAPS.search(word)) << 4)
    if not b.isalpha():
        return b, marks | (bool(_TORN.search(word)) << 2) | (bool(_INNER.search(word)) << 3)
    marks |= 2
    if len(b) >= 4:
        letters = b if b.isascii() else _plain_letters(b)
        if _KNOWN.match(letters):
            marks |= 32 | (bool(_ROUGH.search(letters)) << 6)
    return b, marks


def _wrapped(text: str) -> set[int]:
    """Numbers of the lines (blank ones not counted) that are prose broken into short lines: in their block
    (between blank lines) sentences end in one of ten short lines or more."""
    out: set[int] = set()
    at, block = 0, []

    def close() -> None:
        short = [(i, bool(_STOP.search(x) or _FULL_STOP.search(x))) for i, x in block if x.count(" ") <= 6]
        ends = sum(stop for _, stop in short)
        if ends >= 2 and 10 * ends >= len(short):
            out.update(i for i, _ in short)
        block.clear()

    for line in text.splitlines():
        if line.strip():
            block.append((at, line.strip()))
            at += 1
        else:
            close()
    close()
    return out


def _bare(word: str) -> str:
    return word.strip(".,;:!?…\"'()[]{}<>*_`~“”‘’«»„¿¡-–—").lower()


def _cells(line: str) -> int:
    """Number of short cells that one separator cuts the line into, 0 if it is no row."""
    best = 0
    for s in _SEPARATORS:
        if line.count(s) < 2:
            continue
        cells = re.split(r" {2,}", line.strip()) if s == "  " else line.strip().strip("|").split(s)
        filled = [c.strip() for c in cells]
        if len(cells) < 3:
            continue
        lengths = [len(c.split()) for c in filled if c]
        if not lengths or max(lengths) > 4:
            continue
        best = max(best, len(cells))
    return best


def figures(text: str | None) -> dict:
    """The statistics of one text."""
    text = text or ""
    f = dict.fromkeys(FIGURES, 0.0)
    lines = [x for x in text.splitlines() if x.strip()]
    words = text.split()
    f["n_chars"], f["n_lines"] = len(text), len(lines)
    if not words:
        return f
    n_words = len(words)
    solid = sum(map(len, words))
    plain = text.isascii()
    n = dict.fromkeys(("letter", "digit", "symbol", "wide", "odd", "latin1"), 0)
    for c, k in Counter(text).items():
        if c.isalpha():
            n["letter"] += k
        elif c.isdigit():
            n["digit"] += k
        elif c.isspace():
            continue
        elif not c.isalnum() and c not in PLAIN_MARKS:
            n["symbol"] += k
        if not plain and c > "\x7f":
            n["wide"] += k * _wide(c)
            n["odd"] += k * (c == "�" or "\ue000" <= c <= "\uf8ff" or "\x80" <= c <= "\x9f" or "─" <= c <= "▟")
            n["latin1"] += k * (c <= "ÿ" or c in "€™œž‚„…†‡ˆ‰‹›")
    f["n_words"] = n_words
    f["mean_word"] = solid / (n_words + n["wide"])
    f["longest_word"] = max(map(len, words))
    for name, k in n.items():
        f[f"{name}_share"] = k / solid
    f["ended_share"] = sum([x.rstrip()[-1] in END for x in lines]) / len(lines)
    f["stop_share"] = (len(_STOP.findall(text)) + (0 if plain else len(_FULL_STOP.findall(text)))) / n_words
    # Each different word is looked at once, and those of earlier texts are remembered.
    times = Counter(words)
    stripped, known, tally = {}, {}, [0] * 128
    for w, k in times.items():
        stripped[w], marks = _traits(w)
        known[w] = marks & 1
        tally[marks] += k
    met = [(marks, k) for marks, k in enumerate(tally) if k]
    having = [sum([k for marks, k in met if marks >> bit & 1]) for bit in range(7)]
    bare = [b for b in map(stripped.__getitem__, words) if b]
    f["common_share"] = having[0] / max(1, len(bare))
    f["wordlike_share"], f["torn_share"], f["inner_share"], f["caps_share"] = (having[bit] / n_words for bit in (1, 2, 3, 4))
    f["rough_share"] = having[6] / max(1, having[5])
    f["n_distinct"] = len(set(bare))
    f["distinct_share"] = f["n_distinct"] / max(1, len(bare))
    pieces = Counter(x for x in map(str.strip, _PIECE.split(text)) if x)
    f["n_pieces"] = pieces.total()
    f["top_piece"] = max(pieces.values(), default=0) / max(1, pieces.total())
    f["repeated_pieces"] = 1 - len(pieces) / max(1, pieces.total())
    f["repeated_lines"] = 1 - len(set(lines)) / len(lines)
    paragraphs = [p for p in _PARAGRAPH.split(text) if p.strip()]
    f["repeated_paragraphs"] = 1 - len(set(paragraphs)) / max(1, len(paragraphs))
    pairs = list(zip(bare, bare[1:]))
    for m, grams in ((2, Counter(pairs)), (4, Counter(zip(pairs, pairs[2:])))):
        often = [(k, gram) for gram, k in grams.items() if k > 1]
        f[f"top_{m}gram"] = max([k * (len(g[0]) + len(g[1]) if m == 2 else sum(map(len, g[0] + g[1]))) for k, g in often], default=0) / solid
    # A bullet glued to a word makes another word of it.
    common = lambda ws: sum(_traits(w)[1] & 1 for w in ws)
    rows = items = marks = sentences = 0
    flat_words = flat_common = 0
    wrapped = _wrapped(text)
    at = -1
    for line in lines:
        at += 1
        w = line.split()
        if _RULE.match(line) or _CELL_TAG.search(line):
            rows += 1
            continue
        stops = len(_SENTENCE.findall(line))
        share = sum(map(known.__getitem__, w)) / len(w)
        if not (stops > 1 and share > 0.05) and share < 0.15 and at not in wrapped and _cells(line) >= 3:
            rows += 1
            continue
        marked = _BULLET.match(line)
        body = line[marked.end() :].split() if marked else w
        inner = common(body) / max(1, len(body)) if marked else share
        listed = bool(_FLAG.match(line) or _PATH.match(line)) or (marked and len(body) <= 8 and (inner < 0.34 or len(body) <= 3)) or (len(w) <= 9 and inner < 0.15 and not stops and _SETTING.match(line))
        short = len(w) <= 5 and max(map(len, w)) <= 30 and not line.rstrip().endswith((".", "!", "?", "…", "。", ",")) and not any(map(_wide, line))
        if listed and max(map(len, body)) <= 60:
            items += 1
            marks += 1
        elif short and at not in wrapped:
            items += 1
            flat_words += len(w)
            flat_common += sum(map(known.__getitem__, w))
        else:
            sentences += max(1, stops, len(w) // 20)
    f["n_rows"], f["n_items"], f["n_marked"], f["n_sentences"] = rows, items, marks, sentences
    f["short_words"], f["short_common"] = flat_words, flat_common
    # One row of items: the line with most separators, cut by its commonest one.
    for line in lines:
        if len(line) <= 40:
            continue
        k, s = max((line.count(s), s) for s in _ROW_MARKS)
        if k < max(4, f["inline_items"]):
            continue
        parts = [p.split() for p in (re.split(r" {2,}", line) if s == "  " else line.split(s))]
        parts = [p for p in parts if p]
        if len(parts) >= 5:
            f["inline_items"] = len(parts)
            f["inline_mean"] = sum(map(len, parts)) / len(parts)
            f["inline_short"] = sum(len(p) <= 4 for p in parts) / len(parts)
            f["inline_distinct"] = len({" ".join(p) for p in parts}) / len(parts)
            f["inline_common"] = common(line.split()) / len(line.split())
    return f


FIGURES = (
    "n_chars", "n_lines", "n_words", "mean_word", "longest_word", "letter_share", "digit_share", "wide_share", "symbol_share", "odd_share", "latin1_share",
    "ended_share", "stop_share", "common_share", "wordlike_share", "rough_share", "n_distinct", "distinct_share", "torn_share", "inner_share", "caps_share", "n_pieces", "top_piece",
    "repeated_pieces", "repeated_lines", "repeated_paragraphs", "top_2gram", "top_4gram", "n_rows", "n_items", "n_marked", "n_sentences", "short_words", "short_common",
    "inline_items", "inline_mean", "inline_short", "inline_distinct", "inline_common",
)


def statistics(documents: DataFrame) -> DataFrame:
    """(doc_id, figures) of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pd.DataFrame([figures(t) for t in pdf["text"]], columns=list(FIGURES), dtype="float64")
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, " + ", ".join(f"{c} double" for c in FIGURES))


def kind(f: Callable[[str], Column] = F.col) -> Column:
    """The kind that the figures show: junk, table, list, or null for prose and for empty texts."""
    units = f("n_rows") + f("n_items") + f("n_sentences")
    spaced = f("wide_share") < 0.3
    damaged = (f("odd_share") > 0.15) | (f("latin1_share") > 0.35)
    symbols = spaced & (f("letter_share") + f("digit_share") < 0.2) & (f("symbol_share") > 0.4)
    table = (f("n_rows") >= 2) & (f("n_rows") >= 0.5 * units)
    one_row = (f("inline_items") >= 5) & (f("inline_mean") <= 3.5) & (f("inline_short") > 0.85) & (f("inline_common") < 0.12)
    one_row = one_row & (f("n_rows") < 2) & (f("n_lines") <= 12) & (f("inline_items") > 2 * (f("n_sentences") + f("n_items") + f("n_rows") - 1))
    boilerplate = (f("inline_items") >= 8) & (f("inline_distinct") < 0.5)
    looped = ((f("n_pieces") >= 6) & (f("top_piece") >= 0.8)) | ((f("n_pieces") >= 12) & (f("repeated_pieces") >= 0.8) & spaced)
    looped = looped | ((f("n_lines") >= 12) & (f("repeated_lines") >= 0.8)) | (f("repeated_paragraphs") >= 0.9) | ((f("n_words") >= 40) & (f("top_4gram") >= 0.7))
    bare = (f("short_common") <= 0.12 * f("short_words") + 2) & (f("common_share") < 0.25)
    listed = ((f("n_items") >= 3) & (f("n_items") >= 0.6 * units) & bare) | ((f("n_marked") >= 3) & (f("n_marked") >= 0.6 * units))
    # Few common words say nothing by themselves: the language may be one that COMMON lacks.
    unpunctuated = f("stop_share") < 0.01
    scrambled = (f("inner_share") > 0.025) & (f("common_share") < 0.3) & ((f("caps_share") > 0.01) | (f("rough_share") > 0.1) | (f("stop_share") < 0.03))
    gibberish = (f("n_words") >= 12) & (f("common_share") < 0.06) & unpunctuated & (f("rough_share") > 0.2)
    few = (f("n_distinct") <= 2 * F.sqrt(f("n_words"))) | (f("distinct_share") <= F.when(f("n_words") < 40, 0.55).when(f("n_words") < 100, 0.4).otherwise(0.25))
    heap = (f("n_words") >= 16) & (f("n_words") <= 1000) & (f("common_share") < 0.06) & unpunctuated & few
    heap = heap | ((f("n_words") > 1000) & (f("common_share") < 0.06) & unpunctuated & (f("n_distinct") <= 2 * F.sqrt(f("n_words"))))
    unreadable = spaced & ((f("mean_word") > 15) | (f("torn_share") > 0.15) | scrambled | gibberish | heap)
    return (
        F.when(f("n_words") == 0, None)
        .when(damaged | symbols, "junk")
        .when(one_row & boilerplate, "junk")
        .when(one_row, "list")
        .when(table, "table")
        .when(looped, "junk")
        .when(listed, "list")
        .when(unreadable, "junk")
    )


def judged(documents: DataFrame) -> DataFrame:
    """(doc_id, figures, kind)."""
    return statistics(documents).withColumn("kind", kind())


def unnatural(documents: DataFrame) -> DataFrame:
    """(doc_id, kind) of the documents that are not natural prose, distinct."""
    return judged(documents).filter(F.col("kind").isNotNull()).select("doc_id", "kind").distinct()
