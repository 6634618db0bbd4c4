"""Documents unlike the others of their language and source, by robust distances of text statistics.

What is usual in a group is its minimum covariance determinant: the mean and the
covariance of those three quarters of its vectors that lie closest together.
They are found by concentration steps from two starts, each step one grouped sum
over all rows of all groups at once; nothing here needs a group in one place.
"""

from __future__ import annotations

from functools import reduce
from math import erf, exp, pi, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.operators.extent import BROADCAST_BYTES, checkpoint_once, measured_bytes

SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
# Rules that fail a document whatever is usual.
LEAST_WORDS, MOST_REPEATED = 50, 50

# The vector of a document: logarithms of its length and of its words' length,
# roots of its shares of symbols, of repeated lines and of repeated words; each
# with the deviation that is allowed anywhere, however alike a group is.
VECTOR = {"length": 0.5, "word_length": 0.05, "symbols": 0.03, "lines": 0.04, "repeats": 0.12}
# Vectors are whole numbers, so many of them to that deviation: sums are exact,
# and the same whatever the order in which tasks run.
UNITS = 16
# Share of a group's vectors that the estimate rests on.
COVERED = 0.75
# Fewer different vectors are no estimate; such a group rejects nothing.
LEAST_VECTORS = 30
STEPS = 8
# Distances are ranked by the 64th part of their logarithm.
BUCKETS = 64
# Share of normal vectors that would be as far out as the limit or further.
TAIL = 1e-9
# Estimates too many to broadcast meet the rows in so many parts of every group.
SALTS = 32

NAMES = list(VECTOR)
SIZE = len(NAMES)
PAIRS = [(i, j) for i in range(SIZE) for j in range(i + 1)]


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``.

    A null text counts as empty. Lines are cut at ``\\n`` and count if they hold a
    word. Words of three-word windows that occur twice or more in a text are
    repeated ones; windows are told apart by 64-bit hashes, so two different ones
    among W pass for one with a probability of W * W / 2 ** 65.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, SPACES), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_SPACE))
    size = lambda column: F.size(column).cast("bigint")
    symbols = F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))
    known = docs.withColumns({"__words": words, "__lines": lines, "n_symbols": symbols.cast("bigint")}).drop("text")

    first = F.sequence(F.lit(0), F.size("__words") - 3)
    window = lambda i: F.xxhash64(*[F.get("__words", i + step) for step in range(3)])
    windows = F.when(F.size("__words") > 2, F.transform(first, window))
    known = known.select(
        *[column for column in known.columns if column not in ("__words", "__lines")],
        size("__words").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("bigint").alias("word_chars"),
        (size("__lines") - size(F.array_distinct("__lines"))).alias("n_dup_lines"),
        windows.alias("__windows"),
    )
    # Only texts with a repeated window are sorted.
    some = F.size(F.array_distinct("__windows")) < F.size("__windows")
    placed = F.transform("__windows", lambda hashed, i: F.struct(hashed.alias("hash"), i.alias("at")))
    known = known.withColumn("__sorted", F.when(some, F.sort_array(placed))).drop("__windows")
    beside = lambda x, i, step: x["hash"] == F.get("__sorted", i + step)["hash"]
    twice = F.filter("__sorted", lambda x, i: F.coalesce(beside(x, i, -1), F.lit(False)) | F.coalesce(beside(x, i, 1), F.lit(False)))
    known = known.withColumn("__at", F.sort_array(F.transform(twice, lambda x: x["at"]))).drop("__sorted")
    # A window adds the words that the one before it does not hold.
    covered = F.aggregate(
        "__at",
        F.struct(F.lit(0).alias("words"), F.lit(-3).alias("last")),
        lambda done, at: F.struct((done["words"] + F.least(F.lit(3), at - done["last"])).alias("words"), at.alias("last")),
        lambda done: done["words"].cast("bigint"),
    )
    known = known.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint"))).drop("__at")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return known.withColumn("base_failed", failed)


def _vector() -> dict[str, Column]:
    n = F.col("n_words")
    plain = {
        "length": F.log(n),
        "word_length": F.log(F.col("word_chars") / n),
        "symbols": F.sqrt(F.col("n_symbols") / F.col("word_chars")),
        "lines": F.sqrt(F.col("n_dup_lines") / n),
        "repeats": F.sqrt(F.col("n_repeat_words") / n),
    }
    return {name: F.round(plain[name] * (UNITS / least)).cast("bigint") for name, least in VECTOR.items()}


def _chi_square(x: float, degrees: int) -> float:
    """Distribution function for an odd number of degrees of freedom."""
    terms, term = 0.0, 1.0
    for k in range(1, degrees - 1, 2):
        term = term * x / k if k > 1 else 1.0
        terms += term
    return erf(sqrt(x / 2)) - sqrt(2 * x / pi) * exp(-x / 2) * terms


def _limit(share: float, degrees: int) -> float:
    """Where so large a share of squared distances is below."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi_square(middle, degrees) < share else (low, middle)
    return high


# The spread of the closest share of normal vectors, made that of all of them.
CONSISTENT = COVERED / _chi_square(_limit(COVERED, SIZE), SIZE + 2)
FARTHEST = _limit(1 - TAIL, SIZE)


def _meet(rows: DataFrame, facts: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Rows beside the stored facts of their group: broadcast while small, else joined by parts of a group."""
    if measured_bytes(facts) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(facts), keys, how)
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(SALTS)))
    spread = facts.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return salted.join(spread, [*keys, "__salt"], how).drop("__salt")


def _scaled(rows: DataFrame) -> DataFrame:
    """Rows with their coordinates ``y`` in a group's own axes, from its mean and triangular root."""
    for i, name in enumerate(NAMES):
        seen = reduce(lambda total, j: total + F.col(f"l{i}{j}") * F.col(f"y{j}"), range(i), F.lit(0.0))
        rows = rows.withColumn(f"y{i}", (F.col(name) - F.col(f"m{i}") - seen) / F.col(f"l{i}{i}"))
    return rows


def _square(of: Column) -> Column:
    return of * of


def _distance() -> Column:
    return reduce(Column.__add__, [_square(F.col(f"y{i}")) for i in range(SIZE)])


def _rooted(params: DataFrame) -> DataFrame:
    """Triangular root of each covariance, by columns, and the logarithm of its determinant."""
    for i, j in PAIRS:
        seen = reduce(lambda total, k: total + F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), F.lit(0.0))
        rest = F.col(f"c{i}{j}") - seen
        params = params.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    determinant = reduce(Column.__add__, [2 * F.log(f"l{i}{i}") for i in range(SIZE)])
    return params.withColumn("determinant", determinant)


def _starts(vectors: DataFrame) -> DataFrame:
    """Two starts a group: its medians, with quartiles for a spread. The second ranks by the widest coordinate alone."""
    quartiles = [F.percentile(name, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i, name in enumerate(NAMES)]
    found = vectors.groupBy("group").agg(F.count("*").alias("vectors"), *quartiles).filter(F.col("vectors") >= LEAST_VECTORS)
    # 1.349 deviations of a normal number lie between its quartiles.
    spread = lambda i: _square((F.get(f"q{i}", F.lit(2)) - F.get(f"q{i}", F.lit(0))) / 1.349) + UNITS * UNITS
    means = [F.get(f"q{i}", F.lit(1)).alias(f"m{i}") for i in range(SIZE)]
    own = [(spread(i) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS]
    return _rooted(found.select("group", "vectors", F.explode(F.array(F.lit(0), F.lit(1))).alias("start"), *means, *own))


def _concentrated(vectors: DataFrame, params: DataFrame, first: bool) -> DataFrame:
    """One step: mean and covariance of the nearest share of every group, by the params so far.

    Sums are by group, start and bucket of distance, then over the buckets up to
    the one in which the share is reached.
    """
    rows = _scaled(_meet(vectors, params, ["group"]))
    distance = _distance()
    if first:
        widest = F.greatest(*[_square(F.col(f"y{i}")) for i in range(SIZE)])
        distance = F.when(F.col("start") == 0, distance).otherwise(widest)
    bucket = F.floor(BUCKETS * F.log2(1 + distance)).cast("int")
    sums = [F.sum(name).alias(f"s{i}") for i, name in enumerate(NAMES)]
    products = [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"p{i}{j}") for i, j in PAIRS]
    keys = ["group", "start", "vectors"]
    by_bucket = rows.select(*keys, *NAMES, bucket.alias("bucket")).groupBy(*keys, "bucket").agg(F.count("*").alias("n"), *sums, *products)
    nearer = Window.partitionBy("group", "start").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = by_bucket.withColumn("nearer", F.coalesce(F.sum("n").over(nearer), F.lit(0))).filter(F.col("nearer") < F.ceil(F.col("vectors") * COVERED))
    totals = inside.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", *[f"s{i}" for i in range(SIZE)], *[f"p{i}{j}" for i, j in PAIRS])])
    mean = lambda i: F.col(f"s{i}") / F.col("n")
    covariance = lambda i, j: CONSISTENT * (F.col(f"p{i}{j}") / F.col("n") - mean(i) * mean(j)) + (UNITS * UNITS if i == j else 0)
    fields = [mean(i).alias(f"m{i}") for i in range(SIZE)] + [covariance(i, j).alias(f"c{i}{j}") for i, j in PAIRS]
    return _rooted(totals.select(*keys, *fields))


def estimates(vectors: DataFrame) -> DataFrame:
    """The robust mean and spread of every group of ``vectors`` (``group`` and the vector's columns).

    Copies of a vector count once, so many copies of a text do not become what is
    usual. Steps go on until no group's determinant falls, ``STEPS`` at most; of
    the two starts the one with the smaller determinant counts.
    """
    vectors = checkpoint_once(vectors.select("group", *NAMES).distinct())
    params = checkpoint_once(_starts(vectors))
    for step in range(STEPS):
        before = params.select("group", "start", F.col("determinant").alias("before"))
        params = checkpoint_once(_concentrated(vectors, params, step == 0))
        if step and params.join(before, ["group", "start"]).filter("determinant < before").isEmpty():
            break
    columns = [c for c in params.columns if c not in ("group", "start")]
    best = params.groupBy("group").agg(F.min(F.struct("determinant", "start", *[c for c in columns if c != "determinant"])).alias("best"))
    return checkpoint_once(best.select("group", "best.*").drop("start", "vectors"))


def judged(docs: DataFrame, by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``docs`` without its text, with :func:`statistics`, ``distance`` and ``kept``.

    ``docs`` has ``text`` and the columns ``by``, whose values make a group,
    nulls included; all other columns pass through, but those named like a
    result give way to it. A document that fails a base rule goes and has no
    distance; of the others those go whose squared distance from their group's
    estimate is above ``FARTHEST``. A group with fewer than ``LEAST_VECTORS``
    different vectors rejects nothing. Estimates rest on all documents that pass
    the base rules.
    """
    results = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept"]
    own = [c for c in docs.columns if c not in results and (c in by or c not in ("group", *NAMES))]
    known = checkpoint_once(statistics(docs.select(*own)).withColumn("group", F.to_json(F.struct(*by))))
    passed = known.filter(~F.col("base_failed")).withColumns(_vector())
    usual = estimates(passed)
    rows = known.withColumns({name: F.when(~F.col("base_failed"), column) for name, column in _vector().items()})
    measured = _scaled(_meet(rows, usual, ["group"], "left")).withColumn("distance", _distance())
    near = F.coalesce(F.col("distance") <= FARTHEST, F.lit(True))
    return measured.withColumn("kept", ~F.col("base_failed") & near).select(*[c for c in own if c != "text"], *results)
