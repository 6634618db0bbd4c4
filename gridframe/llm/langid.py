"""Language identification by unigrams of pieces, marginalised over segmentations.

Every language has a probability for each piece of one fixed public vocabulary.
The likelihood of a word is the sum over all ways to cut it into pieces of the
product of their probabilities, which a forward pass computes; a text's is the
product over its words. Words are runs of letters, lower-cased, with the
vocabulary's word mark in front.

``fit`` learns from word counts of a bounded sample of labelled rows: executors
count words, then expectation maximisation runs once per language. The model is
one array of piece probabilities per language. ``predict`` scores whole texts; a
task scores each distinct word once and remembers a bounded number of them.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.llm.kept import kept

# Distinct labelled texts per language in the sample, on average; the words counted from them are bounded strictly.
SAMPLE_DOCS = 1_500
SAMPLE_WORDS = 60_000
# Passes of expectation maximisation.
PASSES = 4
# Count that every piece has beforehand, and the probability of a letter that is no piece.
SMOOTHING = 0.05
UNKNOWN_LETTER = 1e-7
# Words up to here are scored by blocks of one length, longer ones each by itself.
BLOCK_LETTERS = 64
# Learning reads longer runs of letters in such parts.
LEARNT_LETTERS = 24
# After so many letters the forward sums are scaled anew, so that no product of probabilities underflows.
RESCALED = 16
# Numbers a task remembers for the words it has scored.
CACHE_SCORES = 1_600_000
MARK = "▁"
UNDETERMINED = "und"
# A letter, and letters with their combining marks; the same letter for Java.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
LETTER = r"\p{L}"
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Marked lower-case words of a text, whole however long."""
    return [MARK + word for word in WORD.findall((text or "").lower())]


def read_pieces(model: str) -> list[str]:
    """Lower-case letter pieces of a public sentence-piece vocabulary, a letter mark allowed in front."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = {processor.id_to_piece(i).lower() for i in range(processor.get_piece_size())}
    return sorted(p for p in pieces if p and regex.fullmatch(rf"{MARK}?[\p{{L}}\p{{M}}]*", p))


def rolled(codes: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """Hash of strings one letter longer than those hashed in ``before``."""
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * FACTOR
    return mixed if before is None else (before ^ (before >> np.uint64(31))) * FACTOR + mixed


class Pieces:
    """Finds pieces inside words by hash; ``spans`` lists every piece of every word."""

    def __init__(self, pieces: list[str]) -> None:
        self.longest = max(map(len, pieces))
        hashes = np.empty(len(pieces), np.uint64)
        for i, piece in enumerate(pieces):
            codes = np.array([ord(c) for c in piece], np.uint32)
            value = rolled(codes[:1])
            for j in range(1, len(codes)):
                value = rolled(codes[j : j + 1], value)
            hashes[i] = value[0]
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.count = len(pieces)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Piece numbers, -1 for strings that are none."""
        place = np.searchsorted(self.hashes, values)
        place[place == len(self.hashes)] = 0
        return np.where(self.hashes[place] == values, self.order[place], -1)

    def spans(self, words: list[str]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """For words of one length: (start, stop, rows with a piece there, the pieces).

        A single letter is always a span; where it is no piece its number is
        ``count``, which stands for the unknown letter.
        """
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
        found = []
        for start in range(codes.shape[1]):
            value = None
            for stop in range(start + 1, min(codes.shape[1], start + self.longest) + 1):
                value = rolled(codes[:, stop - 1], value)
                piece = self.find(value)
                if stop == start + 1:
                    piece[piece < 0] = self.count
                rows = np.flatnonzero(piece >= 0)
                if len(rows):
                    found.append((start, stop, rows, piece[rows]))
        return found


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Groups of words of one length with their places, in blocks of bounded size."""
    places: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        places.setdefault(len(word), []).append(i)
    for group in places.values():
        size = max(1, 480_000 // len(words[group[0]]))
        for i in range(0, len(group), size):
            block = group[i : i + size]
            yield np.array(block), [words[j] for j in block]


def log_likelihoods(words: list[str], pieces: Pieces, probabilities: np.ndarray) -> np.ndarray:
    """Logarithm of the marginal probability of each word (rows) in each language (columns)."""
    out = np.empty((len(words), probabilities.shape[1]))
    short = [i for i, word in enumerate(words) if len(word) <= BLOCK_LETTERS]
    for places, block in by_length([words[i] for i in short]):
        forward = np.zeros((len(block[0]) + 1, len(block), probabilities.shape[1]))
        forward[0] = 1.0
        scales, scaled = np.zeros(forward.shape[1:]), 0
        for start, stop, rows, piece in pieces.spans(block):
            if start >= scaled + RESCALED:
                reached = forward[start : start + pieces.longest]
                most = reached.max(axis=0)
                reached /= most
                scales, scaled = scales + np.log(most), start
            forward[stop][rows] += forward[start][rows] * probabilities[piece]
        out[[short[i] for i in places]] = np.log(forward[-1]) + scales
    for i, word in enumerate(words):
        if len(word) > BLOCK_LETTERS:
            out[i] = long_likelihood(word, pieces, probabilities)
    return out


def long_likelihood(word: str, pieces: Pieces, probabilities: np.ndarray) -> np.ndarray:
    """The same for one long word: all its pieces are looked up at once, then summed letter by letter."""
    codes = np.frombuffer(word.encode("utf-32-le"), np.uint32)
    # Numbers of the pieces that end behind each letter, by length; the last row of ``chances`` is for none.
    ends, value = np.full((len(codes), pieces.longest), pieces.count + 1), None
    for length in range(1, min(pieces.longest, len(codes)) + 1):
        value = rolled(codes[length - 1 :], None if value is None else value[:-1])
        found = pieces.find(value)
        found[found < 0] = pieces.count + (length > 1)
        ends[length - 1 :, length - 1] = found
    chances = np.vstack([probabilities, np.zeros(probabilities.shape[1])])
    # Forward sums of the last letters, the nearest first.
    last = np.zeros((pieces.longest, probabilities.shape[1]))
    last[0] = 1.0
    scale = np.zeros(probabilities.shape[1])
    for i, numbers in enumerate(ends):
        total = (last * chances[numbers]).sum(axis=0)
        last = np.concatenate([total[None], last[:-1]])
        if i % RESCALED == RESCALED - 1:
            most = last.max(axis=0)
            last /= most
            scale += np.log(most)
    return np.log(last[0]) + scale


def expectation(words: list[str], counts: np.ndarray, pieces: Pieces, probabilities: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of all words, for one language."""
    uses = np.zeros(len(probabilities))
    for places, block in by_length(words):
        length, spans, weight = len(block[0]), pieces.spans(block), counts[places]
        forward, backward = np.zeros((length + 1, len(block))), np.zeros((length + 1, len(block)))
        forward[0] = backward[length] = 1.0
        for start, stop, rows, piece in spans:
            forward[stop][rows] += forward[start][rows] * probabilities[piece]
        for start, stop, rows, piece in reversed(spans):
            backward[start][rows] += backward[stop][rows] * probabilities[piece]
        for start, stop, rows, piece in spans:
            share = forward[start][rows] * probabilities[piece] * backward[stop][rows] / forward[length][rows]
            np.add.at(uses, piece, share * weight[rows])
    return uses


def estimate(words: list[str], counts: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Piece probabilities of one language, the unknown letter last."""
    probabilities = np.full(pieces.count + 1, 1.0 / pieces.count)
    probabilities[-1] = UNKNOWN_LETTER
    for _ in range(PASSES):
        uses = expectation(words, counts, pieces, probabilities)[:-1] + SMOOTHING
        probabilities = np.append(uses / uses.sum(), UNKNOWN_LETTER)
    return probabilities


@dataclass(frozen=True)
class Model:
    """Languages in order and the probability of each piece (rows) in each of them (columns)."""

    pieces: list[str]
    languages: list[str]
    probabilities: np.ndarray = field(repr=False)


def fit(labelled: DataFrame, vocabulary: str, text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS) -> Model:
    """Model of the languages of ``labelled`` rows; rows with a null language or text teach nothing.

    A text is in the sample by its hash, about ``sample_docs`` different ones for
    each language, and counts once there however many copies it has. The text of
    the lowest hash always is, so every language with a word is learned; texts
    without a letter teach nothing. Of each language's words the
    ``sample_words`` most frequent are used, ties by the word. Without any
    labelled row with a word the model has no language.
    """
    vocabulary_pieces = read_pieces(vocabulary)
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter(F.col("lang").isNotNull() & F.col("text").rlike(LETTER))
    space = 1 << 30
    rows = rows.withColumn("place", F.pmod(F.xxhash64("text"), F.lit(space)))
    # The number of different texts need not be exact: it only sets the rate.
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n"), F.min("place").alias("least")).collect()
    if not sizes:
        return Model(vocabulary_pieces, [], np.zeros((len(vocabulary_pieces) + 1, 0)))
    limits = {r.lang: max(min(space, space * sample_docs // max(1, r.n)), r.least + 1) for r in sizes}
    limit = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in sorted(limits.items())))[F.col("lang")]
    sample = rows.filter(F.col("place") < limit).select("lang", "text").distinct()

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, Counter] = {}
            for name, body in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                counts.setdefault(name, Counter()).update(word[i : i + LEARNT_LETTERS] for word in words_of(body) for i in range(0, len(word), LEARNT_LETTERS))
            for name, counted in counts.items():
                yield pa.RecordBatch.from_pydict({"lang": [name] * len(counted), "word": list(counted), "n": list(counted.values())}, schema=schema)

    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
    counted = sample.mapInArrow(count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    frequent = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    counted = counted.withColumn("place", F.row_number().over(frequent)).filter(F.col("place") <= sample_words)

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        learned = estimate(list(group["word"]), group["n"].to_numpy(float), Pieces(vocabulary_pieces))
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "p": [learned]})

    # One array per language, its length that of the vocabulary.
    learned = sorted(counted.groupBy("lang").applyInPandas(learn, "lang string, p array<double>").collect())
    return Model(vocabulary_pieces, [r.lang for r in learned], np.array([r.p for r in learned]).reshape(-1, len(vocabulary_pieces) + 1).T.copy())


class Scorer:
    """Log-likelihoods of texts under every language of a model."""

    def __init__(self, model: Model) -> None:
        self.pieces, self.probabilities = Pieces(model.pieces), model.probabilities
        self.width = max(1, len(model.languages))
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.scores = np.empty((0, self.probabilities.shape[1]))

    def score(self, texts: list[list[str]]) -> np.ndarray:
        """Row per text, zero for a text without words."""
        distinct = set().union(*texts)
        new = list(distinct - self.place.keys())
        if self.place and (len(self.place) + len(new)) * self.width > CACHE_SCORES:
            self._forget()
            new = list(distinct)
        self.scores = np.concatenate([self.scores, log_likelihoods(new, self.pieces, self.probabilities)])
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        out = np.zeros((len(texts), self.probabilities.shape[1]))
        filled = [i for i, words in enumerate(texts) if words]
        if filled:
            places = np.fromiter(map(self.place.__getitem__, chain.from_iterable(texts)), np.int64)
            starts = np.cumsum([0] + [len(texts[i]) for i in filled[:-1]])
            out[filled] = np.add.reduceat(self.scores[places], starts)
        return out


def runs(texts: list[str | None], letters: int = 1_500_000) -> Iterator[list[str | None]]:
    """Texts in runs of about as many letters in all, whatever the length of each."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text or "")
        if size >= letters:
            yield run
            run, size = [], 0
    if run:
        yield run


def predict(df: DataFrame, model: Model, text: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``df`` with the likeliest language of every whole text and its posterior probability.

    A null text, or one without a letter, is ``und`` with score 0, as is every
    text under a model without languages. Languages are equally likely
    beforehand; a tie goes to the name that sorts first. Columns already named
    as the outputs are replaced.
    """
    sent, key = df.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def score_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer, languages = kept(("langid", key), lambda: Scorer(sent.value)), sent.value.languages
        for batch in batches:
            names, scores = [], []
            for run in runs(batch.to_pylist()):
                words = [words_of(body) for body in run]
                for found, row in zip(words, scorer.score(words) if languages else words):
                    if not found or not languages:
                        names.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    best = int(np.argmax(row))
                    names.append(languages[best])
                    scores.append(float(1.0 / np.exp(np.maximum(row - row[best], -700.0)).sum()))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], fields=list(kind))

    # Else a filter on the result would be pushed below it and score every text a second time.
    score = F.arrow_udf(score_batches, "lang string, score double").asNondeterministic()(F.col(text))
    carried = [c for c in df.columns if c not in (lang_out, score_out)]
    scored = df.select(*[F.col(f"`{c}`") for c in carried], score.alias(hidden := f"__scored_{len(df.columns)}"))
    return scored.select(*[F.col(f"`{c}`") for c in carried], F.col(hidden)["lang"].alias(lang_out), F.col(hidden)["score"].alias(score_out))


def held_out(doc_id: Column) -> Column:
    """Rows kept out of learning: remainder 1 of the checksum of the id's text, a null id counting as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1
