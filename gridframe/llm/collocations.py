"""Phrases whose words occur together far more often than apart, best first.

The score of a phrase is its lowest over all cuts, and one cut has its first
word alone, so no phrase scores above ``1000 * n / f(first word)``: counts of
prefixes bound what stands behind them. Frontiers of first words are expanded
from the highest bound down, each by its phrases of two words, then by those up
to five; a language is settled when its 2000th surviving score is above every
bound that is left. What a frontier needs from the corpus is counted by scans
that pick words and phrases with Bloom filters of bounded size, which may pick
too much, never too little; counts themselves are over the phrases' own texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.operators.extent import checkpoint_once

UNKNOWN = "und"
LONGEST = 5
# A Bloom filter has BITS_AN_ITEM bits for each of its phrases, MOST_BITS (64 MB) at most.
BITS_AN_ITEM = 16
MOST_BITS = 1 << 29
PROBES = 4
# Bytes from which on a word is hashed by itself.
LONG_WORD = 64
# Bytes of text that a task looks at together; a longer text is cut behind marks that end a piece.
CHUNK_BYTES = 1 << 20
# Shares of a language's word occurrences that the first frontiers hold; the last holds the rest.
FRONTIERS = (0.1, 0.4)

PIECE_ENDS, SPACE, LINE_END = b".,;:!?\n\v\f\r", 32, 10
_PIECE_END = re.compile(b"[" + PIECE_ENDS + b"]")
_PLAIN = bytes(LINE_END if byte in PIECE_ENDS else byte for byte in range(256)).lower().replace(b"\t", b" ")
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _text_hash(text: bytes) -> int:
    return int.from_bytes(blake2b(text, digest_size=8).digest(), "little")


@dataclass
class Words:
    """The words of a chunk of texts, in order; linked ones have one space between them in ``data``."""

    data: np.ndarray
    start: np.ndarray
    size: np.ndarray
    row: np.ndarray
    linked: np.ndarray
    salt: np.ndarray
    _hashes: dict[int, np.ndarray] = field(default_factory=dict)

    def shifted(self, values: np.ndarray, by: int) -> np.ndarray:
        """The value of the word that many places on; nothing beyond the last."""
        out = np.zeros_like(values)
        if by < len(values):
            out[: len(values) - by] = values[by:]
        return out

    def runs(self, length: int) -> np.ndarray:
        """Whether as many words from each on lie in one piece."""
        fits = np.ones(len(self.start), bool)
        for step in range(length - 1):
            fits &= self.shifted(self.linked, step)
        return fits

    def hashes(self, length: int) -> np.ndarray:
        """Hashes of the phrases of that many words that start at each word, in its text's language."""
        if length not in self._hashes:
            self._hashes[length] = _mixed(self._plain() + self.salt[self.row]) if length == 1 else self._longer(length)
        return self._hashes[length]

    def _longer(self, length: int) -> np.ndarray:
        return _mixed(self.hashes(length - 1) * _STEP + self.shifted(self.hashes(1), length - 1))

    def _plain(self) -> np.ndarray:
        """Hashes of the words alone, by blocks of 8 bytes; long words in one go."""
        blocks = np.ndarray(len(self.data), "<u8", np.concatenate([self.data, np.zeros(8, np.uint8)]), strides=(1,))
        hashes = self.size.astype(np.uint64)
        left, at, mask = self.size, np.arange(len(self.size)), np.uint64(0xFFFFFFFFFFFFFFFF)
        for block in range(LONG_WORD // 8):
            unused = np.uint64(64) - (np.minimum(left, 8).astype(np.uint64) << np.uint64(3))
            value = blocks[self.start[at] + 8 * block] & (mask >> unused)
            hashes[at] = _mixed(hashes[at] * _STEP + value)
            more = left > 8
            left, at = left[more] - 8, at[more]
            if not len(at):
                break
        for i in at:
            hashes[i] = _text_hash(self.data[self.start[i] : self.start[i] + self.size[i]].tobytes())
        return hashes

    def texts(self, first: np.ndarray, length: np.ndarray) -> pa.Array:
        """Phrases as bytes, words joined by one space."""
        start, last = self.start[first], first + length - 1
        size = self.start[last] + self.size[last] - start
        offsets = np.concatenate([[0], np.cumsum(size)])
        if len(first) == len(self.start) and (length == 1).all():
            data = self.data[(self.data != SPACE) & (self.data != LINE_END)]
        else:
            data = self.data[np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _plain_text(text: bytes) -> bytes:
    """Lower case, every mark that ends a piece as a line end, spaces and tabs as one space."""
    text = text.translate(_PLAIN)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text


def words_of(texts: list[bytes], salt: np.ndarray | None = None) -> Words:
    """Words of whole texts, with a number for each text's language; a piece ends with its text."""
    texts = [_plain_text(text) for text in texts]
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = np.zeros(len(data) + 1, bool)
    np.logical_and(data != SPACE, data != LINE_END, out=inside[1:])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = turns[::2], turns[1::2]
    linked = np.zeros(len(start), bool)
    linked[:-1] = (start[1:] == end[:-1] + 1) & (data[end[:-1]] == SPACE)
    row_ends = np.cumsum(np.fromiter((len(text) + 1 for text in texts), np.int64, len(texts)))
    return Words(data, start, end - start, np.searchsorted(row_ends, start, "right"), linked, np.zeros(len(texts), np.uint64) if salt is None else salt)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[str]]]:
    """Texts of a batch with their languages, some bytes at a time; long texts go in parts that end between pieces."""
    texts, languages, size = [], [], 0
    for text, language in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
        at = 0
        while at < len(text):
            stop = len(text)
            if stop - at > CHUNK_BYTES:
                mark = _PIECE_END.search(text, at + CHUNK_BYTES)
                stop = mark.end() if mark else stop
            texts.append(text[at:stop])
            languages.append(language)
            size, at = size + stop - at, stop
            if size >= CHUNK_BYTES:
                yield texts, languages
                texts, languages, size = [], [], 0
    if texts:
        yield texts, languages


Picked = tuple[np.ndarray, np.ndarray]
FOUND = "lang string, phrase binary, f bigint"


def _counted(batches: Iterator[pa.RecordBatch], pick: Callable[[Words], Picked]) -> Iterator[pa.RecordBatch]:
    """The phrases that ``pick`` chooses (first word, number of words), counted by chunk and language."""
    for batch in batches:
        for texts, languages in _chunks(batch):
            names = sorted(set(languages))
            # Texts by language, so a language's phrases are side by side.
            order = sorted(range(len(texts)), key=languages.__getitem__)
            codes = np.array([names.index(languages[i]) for i in order])
            salts = np.array([_text_hash(name.encode()) for name in names], np.uint64)
            words = words_of([texts[i] for i in order], salts[codes])
            first, length = pick(words)
            first, length = (first, length) if len(names) == 1 else _in_order(first, length)
            phrases = words.texts(first, length)
            bounds = np.searchsorted(codes[words.row[first]], np.arange(len(names) + 1))
            for name, low, high in zip(names, bounds[:-1], bounds[1:], strict=True):
                if high > low:
                    counts = phrases.slice(low, high - low).value_counts()
                    yield pa.record_batch([pa.repeat(name, len(counts)), counts.field("values").cast(pa.binary()), counts.field("counts")], names=["lang", "phrase", "f"])


def _in_order(first: np.ndarray, length: np.ndarray) -> Picked:
    order = np.argsort(first, kind="stable")
    return first[order], length[order]


class Bloom:
    """Which phrases may be in a set, by their hashes."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    def has(self, hashes: np.ndarray, where: np.ndarray | None = None) -> np.ndarray:
        """Of the hashes, or of those ``where`` says: false elsewhere."""
        found = np.zeros(len(hashes), bool)
        at = np.arange(len(hashes)) if where is None else np.flatnonzero(where)
        own = hashes if where is None else hashes[at]
        for probe in range(PROBES):
            bit = _probe(own, probe, self.mask)
            hit = (self.words[(bit >> np.uint64(6)).view(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
            at, own = at[hit], own[hit]
        found[at] = True
        return found


def _probe(hashes: np.ndarray, no: int, mask: np.uint64) -> np.ndarray:
    """The bits of a phrase: parts of its hash, and beyond them of a hash of that."""
    return (hashes if no == 0 else _mixed(hashes + np.uint64(no * int(_STEP) % (1 << 64)))) & mask


def bloom(phrases: DataFrame) -> Bloom:
    """Filter of a table ``lang, phrase``: its bits are gathered by the table's tasks, its words come to the driver."""
    n = phrases.count()
    bits = min(MOST_BITS, 1 << max(10, (n * BITS_AN_ITEM - 1).bit_length()))
    mask = np.uint64(bits - 1)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, languages in _chunks(batch):
                names = np.array([_text_hash(language.encode()) for language in languages], np.uint64)
                words = words_of(texts, names)
                first = np.flatnonzero(np.concatenate([[True], words.row[1:] != words.row[:-1]]))
                length = np.diff(np.concatenate([first, [len(words.start)]]))
                hashes = np.choose(length - 1, [words.hashes(m)[first] for m in range(1, LONGEST + 1)])
                at = np.concatenate([_probe(hashes, no, mask) for no in range(PROBES)])
                yield pa.record_batch([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["word", "bits"])

    rows = phrases.select("lang", F.col("phrase").cast("binary").alias("text")).mapInArrow(places, "word bigint, bits bigint")
    found = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return Bloom(words)


def _count(texts: DataFrame, pick: Callable[[Words], Picked], *filters: Bloom, least: int = 1) -> DataFrame:
    """``lang, phrase, f`` of picked phrases with at least ``least`` occurrences."""
    sent = texts.sparkSession.sparkContext.broadcast(filters)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted(batches, lambda words: pick(words, *sent.value))

    counts = texts.mapInArrow(scan, FOUND).groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return counts.select("lang", F.col("phrase").cast("string").alias("phrase"), "f")


def _each_word(words: Words) -> Picked:
    return np.arange(len(words.start)), np.ones(len(words.start), np.int64)


def _of_lengths(chosen: dict[int, np.ndarray]) -> Picked:
    firsts = [np.flatnonzero(fits) for fits in chosen.values()]
    return np.concatenate(firsts), np.repeat(list(chosen), [len(first) for first in firsts])


def _pairs(words: Words, frontier: Bloom, frequent: Bloom) -> Picked:
    """Two words, the first of the frontier and the second frequent."""
    fits = frontier.has(words.hashes(1), words.linked)
    return _of_lengths({2: fits & words.shifted(frequent.has(words.hashes(1), np.concatenate([[False], fits[:-1]])), 1)})


def _grown(words: Words, pairs: Bloom, frequent: Bloom) -> Picked:
    """Three to five words that begin with a frequent pair and go on with frequent words."""
    fits, chosen = pairs.has(words.hashes(2), words.linked), {}
    for length in range(3, LONGEST + 1):
        fits = fits & words.runs(length)
        last = np.zeros(len(fits), bool)
        last[length - 1 :] = fits[: len(fits) - length + 1]
        fits = fits & words.shifted(frequent.has(words.hashes(1), last), length - 1)
        chosen[length] = fits
    return _of_lengths(chosen)


def _around(words: Words, open_phrases: Bloom, ends: Bloom) -> Picked:
    """Second parts of open phrases, and open phrases with the word before them."""
    chosen, behind = {}, np.zeros(len(words.start), bool)
    for length in range(2, LONGEST + 1):
        fits = words.runs(length)
        chosen[length] = fits & behind
        if length < LONGEST:
            chosen[length] |= ends.has(words.hashes(length), fits)
            behind = words.shifted(open_phrases.has(words.hashes(length), fits), 1)
    return _of_lengths(chosen)


def _size(phrase: Column) -> Column:
    return F.char_length(phrase) - F.char_length(F.translate(phrase, " ", "")) + 1


def _first(phrase: Column, words: Column | int) -> Column:
    """The first words of a phrase, or its last ones if the number is negative."""
    return F.call_function("substring_index", phrase, F.lit(" "), words if isinstance(words, Column) else F.lit(words))


def _score(a: Column, n: Column, l: Column, r: Column) -> Column:  # noqa: E741
    exact = [value.cast("decimal(19,0)") for value in (a, n, l, r)]
    return F.call_function("div", (F.lit(1000).cast("decimal(4,0)") * exact[0] * exact[1]).cast("decimal(38,0)"), exact[2] * exact[3])


def collocations(docs: DataFrame, top: int = 2000, least: int = 100, percent: int = 100) -> DataFrame:
    """Each language's ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    ``docs`` has ``text`` and ``lang``; other columns are ignored, null texts
    count as empty and a null language as ``und``. Texts are lower-cased (A-Z),
    cut into pieces at ``.,;:!?`` and line ends, and pieces into words at spaces
    and tabs. A phrase has two to five words of one piece and at least ``least``
    occurrences, overlaps and repeated rows included. Cut in two, with ``l`` and
    ``r`` the occurrences of its parts, it scores ``floor(1000 * a * n / (l *
    r))``, ``n`` being its language's word occurrences; its lowest cut counts, of
    equal ones that with the shortest first part. A phrase goes if a longer one
    around it has at least ``percent`` of its occurrences. Order: score, then
    ``a``, then the phrase; each falling but the last.

    Any longer phrase around one is at most as frequent as the one with a single
    word more, so a phrase goes by its neighbours of one word alone.
    """
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    counted = checkpoint_once(_count(texts, _each_word))
    totals = checkpoint_once(counted.groupBy("lang").agg(F.sum("f").alias("n")))
    words = checkpoint_once(_in_frontiers(counted.filter(F.col("f") >= least), totals))
    frequent = bloom(words)
    settled = totals.select("lang", F.lit(0).cast("decimal(38,0)").alias("floor"))
    found = None
    for frontier in range(len(FRONTIERS) + 1):
        bound = F.call_function("div", (F.lit(1000).cast("decimal(4,0)") * F.col("n")).cast("decimal(38,0)"), F.col("f").cast("decimal(19,0)"))
        reach = words.filter(F.col("frontier") == frontier).join(totals, "lang").join(settled, "lang").filter(bound >= F.col("floor"))
        reach = reach.select("lang", "phrase", "f")
        if reach.isEmpty():
            continue
        fresh = _expanded(texts, words, totals, reach, frequent, settled, least, percent)
        found = checkpoint_once(_best(fresh if found is None else found.drop("rank").unionByName(fresh), top))
        last = found.groupBy("lang").agg(F.max("rank").alias("rank"), F.min("score").alias("floor")).filter(F.col("rank") >= top)
        settled = checkpoint_once(totals.join(last, "lang", "left").select("lang", F.coalesce("floor", F.lit(0)).cast("decimal(38,0)").alias("floor")))
    if found is None:
        found = _best(words.join(totals, "lang").filter(F.lit(False)).selectExpr("lang", "phrase", "f as a", "f as l", "f as r", "n", "f as score"), top)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _in_frontiers(words: DataFrame, totals: DataFrame) -> DataFrame:
    """Frequent words with the frontier they belong to: rare words first, by their share of all occurrences.

    Words are dealt out by the eighth of a power of two that their count is in,
    so the running sum is over a few hundred numbers of a language.
    """
    level = F.floor(F.log2("f") * 8).cast("int")
    levels = words.groupBy("lang", level.alias("level")).agg(F.sum("f").alias("sum"))
    before = Window.partitionBy("lang").orderBy("level").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.sum("sum").over(before) / F.sum("sum").over(Window.partitionBy("lang"))
    frontier = sum((F.when(share > part, 1).otherwise(0) for part in FRONTIERS), F.lit(0))
    dealt = levels.withColumn("frontier", frontier).select("lang", "level", "frontier")
    return words.withColumn("level", level).join(dealt, ["lang", "level"]).select("lang", "phrase", "f", "frontier")


def _expanded(
    texts: DataFrame, words: DataFrame, totals: DataFrame, reach: DataFrame, frequent: Bloom, settled: DataFrame, least: int, percent: int
) -> DataFrame:
    """Surviving phrases that begin with a word of ``reach`` and score no less than their language's floor."""
    pairs = checkpoint_once(_count(texts, _pairs, bloom(reach), frequent, least=least))
    own = reach.select("lang", F.col("phrase").alias("word"))
    # What a filter let through by mistake goes.
    pairs = checkpoint_once(pairs.join(own, [pairs["lang"] == own["lang"], _first(pairs["phrase"], 1) == own["word"]], "left_semi"))
    starts = pairs.select("lang", F.col("phrase").alias("start"))
    longer = _count(texts, _grown, bloom(pairs), frequent, least=least)
    longer = longer.join(starts, [longer["lang"] == starts["lang"], _first(longer["phrase"], 2) == starts["start"]], "left_semi")
    phrases = checkpoint_once(pairs.unionByName(longer).withColumn("m", _size(F.col("phrase"))))

    # One word more on the right: counted already, as it begins with the same words.
    right = phrases.filter("m > 2").groupBy("lang", _first(F.col("phrase"), F.col("m") - 1).alias("phrase")).agg(F.max("f").alias("right"))
    alone = phrases.join(right, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("right") < percent * F.col("f"), F.lit(True)))
    single = words.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    # The cut before the last word needs no further counts and bounds the score.
    cut = alone.select("lang", "phrase", "m", F.col("f").alias("a"), _first(F.col("phrase"), F.col("m") - 1).alias("head"), _first(F.col("phrase"), -1).alias("tail"))
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("head_f")).unionByName(reach.select("lang", F.col("phrase").alias("head"), F.col("f").alias("head_f")))
    tails = single.toDF("lang", "tail", "tail_f")
    bounded = cut.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang").join(settled, "lang")
    bounded = bounded.filter(_score(F.col("a"), F.col("n"), F.col("head_f"), F.col("tail_f")) >= F.col("floor"))
    wanted = checkpoint_once(bounded.select("lang", "phrase", "m", "a", "n", "floor"))

    cuts = wanted.select("*", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.withColumn("head", _first(F.col("phrase"), F.col("k"))).withColumn("part", _first(F.col("phrase"), F.col("k") - F.col("m")))
    parts = cuts.filter("m - k > 1").select("lang", F.col("part").alias("phrase")).distinct()
    around = checkpoint_once(_count(texts, _around, bloom(wanted.filter(F.col("m") < LONGEST)), bloom(parts)))
    known = single.unionByName(around.join(parts, ["lang", "phrase"], "left_semi").select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f")))
    scored = cuts.join(heads, ["lang", "head"]).join(known, ["lang", "part"])
    cut_score = F.struct(_score(F.col("a"), F.col("n"), F.col("head_f"), F.col("part_f")).alias("score"), "k", F.col("head_f").alias("l"), F.col("part_f").alias("r"))
    lowest = scored.groupBy("lang", "phrase", "a", "n", "floor").agg(F.min(cut_score).alias("cut"))
    rest = F.substring("phrase", F.instr("phrase", " ") + 1, F.char_length("phrase"))
    left = around.select("lang", rest.alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("left"))
    free = lowest.join(left, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("left") < percent * F.col("a"), F.lit(True)))
    return free.filter(F.col("cut.score") >= F.col("floor")).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
