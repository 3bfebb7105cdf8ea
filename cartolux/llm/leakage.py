"""Evaluation texts leaking into training text, found by spaced-seed hashing.

Texts become words in a canonical dress (``words``). A seed is a mask over consecutive words; the
words under its ones are hashed, those under its zeros ignored, so an altered word under a zero does
not break the hit. Test hashes and training hashes are joined; around the hits the overlap is
verified by words, tolerant of altered, missing and misspelt ones.

Every leak leaves a run of untouched words: with k changes among the n words of an item some run of
ceil((n-k)/(k+1)) of them is whole, and a passage of fifteen words is one. An item's masks span no
more than that run, so at least one window of each of them lies inside it and is hit, whatever
happens to the rest of the text; the words under their zeros may differ, so altered words within
reach of a mask do not matter either. All masks of three places or more are spaced. One and two words
have no place to ignore: such items are hashed whole, and a document keeps one hit of each.

Scale. The scan of the corpus keeps only hashes that pass a fixed-size bit filter made of the test
hashes (``FILTER_BITS`` bits, broadcast, whatever the input), and sends the survivors through an
ordinary join with the test hashes, exact for any number of items. Documents with survivors are
written once to the shared folder; pairs are verified row by row, only around their hits.

A pair is reported if the document holds ``RUN`` consecutive words of the item, or the whole item
with at most one word in ten changed (edit distance over words). An opening shared by items counts
for each.

Hot hashes and items. Joins on hashes and on items are broadcast only if the item side is known to be
small, else salted by document, so a passage or a one-word item that is in a third of all documents is
spread.

Words. A number with a decimal mark is one word of a text, but counts as the two it is written with
where a tenth of an item's words is taken (``changes``).

Cases. Null, empty and blank texts leak nothing and are leaked by nothing. An item of fewer than
``RUN`` words can only be held as a whole. Repeated documents are each reported. A null id is
reported as null.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import Stage, salted_join

RUN = 15
CHANGED = 10
FILTER_BITS = 1 << 27
#: Masks by span; an item uses those of the largest span that the run its leaks leave can hold.
MASKS = {
    8: ("11011011", "11101011"),
    7: ("1101011", "1011101"),
    6: ("110111", "111011"),
    5: ("11011", "10111"),
    4: ("1101", "1011"),
    3: ("101",),
    2: ("11",),
    1: ("1",),
}

_TAG = re.compile(r"</?(?:b|i|u|em|strong|span|code|a|mark|sub|sup|small|s|q|font|tt)\b[^<>]*>", re.I)
_BLOCK_TAG = re.compile(r"<[/!?]?[A-Za-z][^<>]*>|<!--|-->")
_ENTITY = re.compile(r"&(?:#\d+|#x[0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")
_BREAK = re.compile(r"(?<=[^\W\d_])[-\u2010][ \t]*\r?\n[ \t>]*(?=[^\W\d_])")
_SOFT = re.compile(r"\u00ad[ \t]*\r?\n[ \t>]*")
_INVISIBLE = re.compile("[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0]")
_SPACE = re.compile(r"[\s\u2028\u2029\u0085\x1c-\x1f\u2014\u2015/|]+")
_MARK = re.compile(r"[\W_]+")
_DECIMAL = re.compile(r"(?<=\d)[.,](?=\d)")


def words(text: str | None) -> list[str]:
    """Words without letter case, punctuation, markup, line breaks, kinds of blanks, invisible
    characters, and the width or joining of letters."""
    if not text:
        return []
    if "\u00ad" in text:
        text = _SOFT.sub("", text)
    if "&" in text:
        import html

        text = _ENTITY.sub(lambda m: html.unescape(m[0]), text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text))
    if "<" in text:
        text = _BLOCK_TAG.sub(" ", _TAG.sub("", text))
    if "-" in text or "\u2010" in text:
        text = _BREAK.sub("", text)
    return [w for w in (_MARK.sub("", x) for x in _SPACE.split(text.casefold())) if w]


def changes(text: str | None, changed: int = CHANGED) -> int:
    """The number of words that may differ in a leak of the whole item: one in ``changed``."""
    return sum(max(1, len(_DECIMAL.findall(w)) + 1) for w in (text or "").split()) // changed


def weight(n: int, k: int | None = None) -> int:
    """The span of the heaviest masks that a leak of an item of ``n`` words with at most ``k`` changes (one in
    ``CHANGED`` if not given) must hit."""
    k = n // CHANGED if k is None else k
    return max(1, min(max(MASKS), -(-(n - k) // (k + 1))))


def seed_hashes(codes: np.ndarray, mask: str) -> np.ndarray:
    """Hash at each start of ``mask`` over word codes (uint64)."""
    n = len(codes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, hash_of_mask(mask), np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            h = (h ^ codes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h


def hash_of_mask(mask: str) -> int:
    return int("1" + mask, 2) * 0x2545F4914F6CDD1D % (1 << 64)


def word_codes(all_words: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(all_words, dtype=object), categorize=True) if all_words else np.empty(0, np.uint64)


def _item_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for item, text in zip(pdf["item_id"], pdf["text"]):
            w = words(text)
            codes = word_codes(w)
            for mask in MASKS[weight(len(w), changes(text))] if w else ():
                for at, h in enumerate(seed_hashes(codes, mask).astype(np.int64).tolist()):
                    rows.append((item, h, at))
        yield pd.DataFrame(rows, columns=["item_id", "hash", "item_at"])


def bit_filter(hashes: DataFrame) -> bytes:
    """A bit per hash value modulo ``FILTER_BITS``. Its size is fixed. Hashes stream through the driver
    a partition at a time; they are those of the test items only."""
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    slot = F.pmod(F.col("hash"), F.lit(FILTER_BITS)).cast("int")
    for row in hashes.select(slot.alias("s")).groupBy(F.shiftright("s", 12).alias("c")).agg(F.collect_set("s").alias("s")).toLocalIterator():
        s = np.array(row["s"], np.int64)
        np.bitwise_or.at(bits, s >> 3, (1 << (s & 7)).astype(np.uint8))
    return bits.tobytes()


def _survivors(packed, masks: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.frombuffer(packed.value, np.uint8)
        for pdf in batches:
            split = [words(t) for t in pdf["text"]]
            bounds = np.cumsum([0, *map(len, split)])
            codes = word_codes([w for ws in split for w in ws])
            found: list[list[tuple[int, int]]] = [[] for _ in split]
            for mask in masks:
                h = seed_hashes(codes, mask)
                s = h & np.uint64(FILTER_BITS - 1)
                at = np.flatnonzero((bits[(s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8)) & 1)
                doc = np.searchsorted(bounds, at, side="right") - 1
                inside = at + len(mask) <= bounds[doc + 1] if len(at) else np.empty(0, bool)
                if "0" not in mask:
                    # The whole item is hashed: its first hit in a document is as good as all.
                    at, doc = at[inside], doc[inside]
                    _, first = np.unique(np.stack([doc, h[at].astype(np.int64)], 1), axis=0, return_index=True) if len(at) else (None, np.empty(0, int))
                    at, doc, inside = at[first], doc[first], np.ones(len(first), bool)
                for d, a, x in zip(doc[inside].tolist(), at[inside].tolist(), h[at[inside]].astype(np.int64).tolist()):
                    found[d].append((x, a - int(bounds[d])))
            keep = [i for i, f in enumerate(found) if f]
            if not keep:
                continue
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].iloc[keep],
                "words": [" ".join(split[i]) for i in keep],
                "hits": [[{"hash": x, "doc_at": a} for x, a in found[i]] for i in keep],
            })

    return run


def longest_run(doc: list[str], item: list[str], diagonals: set[int], need: int) -> bool:
    """Whether ``need`` words of the item stand in a row in the document, along any of the diagonals."""
    for d in diagonals:
        run = 0
        for i in range(max(0, -d), min(len(item), len(doc) - d)):
            run = run + 1 if item[i] == doc[i + d] else 0
            if run >= need:
                return True
    return False


def within_edits(doc: list[str], item: list[str], most: int) -> bool:
    """Whether a stretch of ``doc`` is the item with at most ``most`` words replaced, left out or put in."""
    row = np.zeros(len(doc) + 1, np.int64)
    target = np.array(doc, dtype=object)
    step = np.arange(len(doc) + 1)
    for i, w in enumerate(item, 1):
        cost = np.concatenate([[i], np.minimum(row[:-1] + (target != w), row[1:] + 1)])
        row = np.minimum.accumulate(cost - step) + step
        if row.min() > most:
            return False
    return bool(row.min() <= most)


def leaks(doc: list[str], item: list[str], diagonals: set[int], k: int, run: int = RUN) -> bool:
    if len(item) >= run and longest_run(doc, item, diagonals, run):
        return True
    done = None
    for d in sorted(diagonals):
        if done is not None and d <= done:
            continue
        done = d + k
        if within_edits(doc[max(0, d - k) : d + len(item) + 2 * k + 1], item, k):
            return True
    return False


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        good = [leaks(d.split(" "), words(t), set(map(int, g)), changes(t)) for d, t, g in zip(pdf["words"], pdf["text"], pdf["diagonals"])]
        yield pdf.loc[good, ["doc_id", "item_id"]]


def leaked(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id), distinct."""
    spark = documents.sparkSession
    stage = Stage(spark)
    kinds = dict(documents.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    items = items.select("item_id", "text")
    hashes = stage.write(items.mapInPandas(_item_hashes, f"item_id {kinds[1]}, hash long, item_at int"), "items")
    packed = spark.sparkContext.broadcast(bit_filter(hashes))
    used = items.mapInPandas(_spans, "span int").distinct().collect()  # at most one row per span of MASKS
    masks = [m for row in used for m in MASKS[row["span"]]]
    scanned = documents.select("doc_id", "text").filter(F.length("text") > 0).mapInPandas(_survivors(packed, masks), f"doc_id {kinds[0]}, words string, hits array<struct<hash:long,doc_at:int>>")
    scanned = stage.write(scanned.withColumn("_doc", F.xxhash64("doc_id", "words")), "documents")
    pairs = (
        scanned.select("_doc", F.explode("hits").alias("h"))
        .select("_doc", F.col("h.hash").alias("hash"), F.col("h.doc_at").alias("doc_at"))
    )
    pairs = (
        salted_join(pairs, hashes, ["hash"], [F.col("_doc"), F.col("doc_at")])
        .groupBy("_doc", "item_id")
        .agg(F.collect_set(F.col("doc_at") - F.col("item_at")).alias("diagonals"))
    )
    found = pairs.join(scanned.select("_doc", "doc_id", "words"), "_doc")
    checked = salted_join(found, stage.write(items, "texts"), ["item_id"], [F.col("_doc")])
    return checked.select("doc_id", "item_id", "words", "text", "diagonals").mapInPandas(_verify, f"doc_id {kinds[0]}, item_id {kinds[1]}").distinct()


def _spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"span": sorted({weight(len(w), changes(t)) for t in pdf["text"] for w in [words(t)] if w})}, dtype="int32")
