"""Near-duplicate documents by SetSketch registers, bands, joint likelihood and exact verification.

A document is the set of its word shingles. Its sketch has ``REGISTERS``
registers: the minimum over the set of a hash as an exponential variable, kept
as the exponent of ``BASE`` at which it was truncated. Registers of a union are
the maxima of the registers, so sketches merge, and two sets agree in a register
about as often as their similarity.

1. Documents with equal sets form a class with a number of its own; one of them stands for it.
2. Bands of ``ROWS`` registers, fewer for limits below 0.8, send classes to
   buckets. Two sets at the limit share no bucket with a probability below 4e-6
   (below 3e-9 at 0.85).
3. Every class is verified against the class that leads most of its buckets.
   Links give components; pairs of a similarity not far below the limit give
   families, the places where most other links are.
4. Inside a family, classes of different components are compared in blocks of
   bounded size, each block holding a text once however many pairs it is in.
   Across families, classes that share a bucket are compared by their sketches.
   Pairs already connected cannot change a component, so they are left out, and
   pairs whose likeliest similarity is more than ``MARGIN`` (over five standard
   errors) below the limit are not verified. All other pairs are.
5. A link counts only if the full sets of both texts pass the limit.

Large buckets and families are compared in pairs of blocks, so no group exceeds
two blocks. Exact copies never meet each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.llm.components import connected_components
from gridframe.llm.kept import kept
from gridframe.operators.extent import checkpoint_once

REGISTERS, ROWS = 252, 6
# Chance that two sets at the limit share no bucket.
MISSED = 4e-6
BASE, RATE, TOP = 1.02, 20.0, 65_534
MARGIN = 0.12
# How far below the limit a pair still makes one family.
FAMILY_MARGIN = 0.25
# Classes of a bucket that are compared with as many others at a time.
BLOCK = 1_500
# Shingles of all texts in a block of a family, on average.
FAMILY_SHINGLES = 250_000
# Shingles of all texts that one verifying group holds, more only where a single text has more.
GROUP_SHINGLES = 60_000
# Word hashes a task remembers, and shingles it sketches at a time.
CACHE_WORDS, RUN_SHINGLES = 300_000, 200_000

_random = np.random.default_rng(20)
SEEDS = _random.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
FACTORS = _random.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
WORD_FACTORS = _random.integers(0, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """64-bit hash by word; bounded."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value
        return value


def shingle_set(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text.

    Words are runs of anything but the six ASCII blanks, A-Z lower-cased. Fewer
    words than ``width`` are one shingle; no word gives none.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    used = min(width, len(values))
    mixed = np.full(len(values) - used + 1, used, np.uint64)
    for j in range(used):
        mixed ^= mixed >> np.uint64(29)
        mixed = mixed * WORD_FACTORS[j % 64] + values[j : len(values) - used + 1 + j]
    mixed = (mixed ^ (mixed >> np.uint64(30))) * MIX
    mixed = np.sort(mixed ^ (mixed >> np.uint64(31)))
    return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (columns) of non-empty sets (rows)."""
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    least = np.empty((len(sets), REGISTERS), np.uint32)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat((values ^ SEEDS[i]) * FACTORS[i], starts)
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def merge(sketches: np.ndarray) -> np.ndarray:
    """Registers of the union of the sketched sets (rows)."""
    return sketches.max(axis=0)


def rows_for(percent: int) -> int:
    """Registers of a band: the most, up to ``ROWS``, with which two sets at the limit miss each other less often than ``MISSED``."""
    fits = [r for r in range(1, ROWS + 1) if REGISTERS % r == 0 and (1 - (percent / 100) ** r) ** (REGISTERS // r) < MISSED]
    return max(fits)


def band_keys(sketches: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band of ``rows`` registers (columns) of each sketch (rows)."""
    bands = sketches.reshape(len(sketches), REGISTERS // rows, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, REGISTERS // rows + 1, dtype=np.uint64) * MIX, bands.shape[:2]).copy()
    for j in range(rows):
        keys = (keys ^ bands[:, :, j]) * WORD_FACTORS[j]
        keys ^= keys >> np.uint64(32)
    return keys.view(np.int64)


def similarity(equal: np.ndarray, greater: np.ndarray, sizes: np.ndarray, other_sizes: np.ndarray) -> np.ndarray:
    """Likeliest similarity given in how many registers the first sketch equals or exceeds the second.

    Sizes of both sets are known, so the similarity is the only unknown; the
    likelihood of the three counts is compared on a grid of it.
    """
    share = sizes / (sizes + other_sizes)
    most = np.minimum(sizes, other_sizes) / np.maximum(sizes, other_sizes)
    grid = np.linspace(0, 1, 101)[:, None] * most

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    above, below = chance(share - (1 - share) * grid), chance((1 - share) - share * grid)
    floor = 1e-12
    likelihood = (
        greater * np.log(np.maximum(above, floor))
        + (REGISTERS - equal - greater) * np.log(np.maximum(below, floor))
        + equal * np.log(np.maximum(1 - above - below, floor))
    )
    return grid[np.argmax(likelihood, axis=0), np.arange(len(share))]


def allowed(equal: np.ndarray, greater: np.ndarray, sizes: np.ndarray, other_sizes: np.ndarray, least: float) -> np.ndarray:
    """Which pairs may reach the limit: their likeliest similarity is at least ``least``."""
    return similarity(equal, greater, sizes.astype(float), other_sizes.astype(float)) >= least if len(equal) else np.zeros(0, bool)


def likely_pairs(rows: pd.DataFrame, least: float, band_rows: int = ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of one group, but of different families (and blocks, if the group has two), that may reach the limit.

    Rows of a group are consecutive. All groups are compared at once: every row
    with the next one, then with the one after it, until no two rows so far
    apart share a group. A pair is given in the first band it shares only.
    """
    sketches = np.frombuffer(b"".join(rows["sketch"]), np.uint16).reshape(len(rows), REGISTERS)
    group = rows.groupby(["bucket", "low", "high"], sort=False).ngroup().to_numpy()
    family, sizes, band, block = (rows[c].to_numpy() for c in ("family", "n_shingles", "band", "block"))
    single = (rows["low"] == rows["high"]).to_numpy()
    lefts, rights = [], []
    for step in range(1, len(rows)):
        near = np.flatnonzero(group[:-step] == group[step:])
        if not len(near):
            break
        other = near + step
        wanted = (family[near] != family[other]) & (single[near] | (block[near] != block[other]))
        wanted &= np.minimum(sizes[near], sizes[other]) >= least * np.maximum(sizes[near], sizes[other])
        near = near[wanted]
        for low in range(0, len(near), 10_000):
            i = near[low : low + 10_000]
            j = i + step
            same = sketches[i] == sketches[j]
            equal = same.sum(axis=1)
            # Equal registers alone rule out most pairs; the small allowance is for those that are equal by chance.
            close = np.flatnonzero(equal >= (least - 0.05) * REGISTERS)
            close = close[same[close].reshape(len(close), REGISTERS // band_rows, band_rows).all(axis=2).argmax(axis=1) == band[i[close]]]
            i, j, equal = i[close], j[close], equal[close]
            keep = allowed(equal, (sketches[i] > sketches[j]).sum(axis=1), sizes[i], sizes[j], least)
            lefts.append(i[keep])
            rights.append(j[keep])
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(lefts or empty), np.concatenate(rights or empty)


def common(one: np.ndarray, other: np.ndarray) -> int:
    """Number of values that two sorted sets share."""
    if len(one) > len(other):
        one, other = other, one
    place = np.searchsorted(other, one)
    place[place == len(other)] = 0
    return int((other[place] == one).sum()) if len(other) else 0


def family_links(reps: list[int], parts: list[int], sides: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join the components of one family's block, or of two blocks across ``sides``, as far as they can be joined.

    Components that a link has joined are one from then on, so a link is given
    only where it joins two.
    """
    root: dict[int, int] = {part: part for part in parts}

    def find(part: int) -> int:
        while root[part] != part:
            root[part] = root[root[part]]
            part = root[part]
        return part

    sizes, side = np.array([len(s) for s in sets]), np.array(sides)
    sketches, least = registers(sets), percent / 100 - MARGIN
    across = side.min() != side.max()
    label = np.array(parts)
    links = []
    for i in range(len(reps)):
        later = slice(i + 1, None)
        wanted = label[later] != label[i]
        if across:
            wanted &= side[later] != side[i]
        wanted &= 100 * np.minimum(sizes[later], sizes[i]) >= percent * np.maximum(sizes[later], sizes[i])
        j = np.flatnonzero(wanted) + i + 1
        equal = (sketches[j] == sketches[i]).sum(axis=1)
        close = equal >= (least - 0.05) * REGISTERS
        j, equal = j[close], equal[close]
        j = j[allowed(equal, (sketches[i] > sketches[j]).sum(axis=1), np.full(len(j), sizes[i]), sizes[j], least)]
        for k in j:
            if find(parts[i]) != find(parts[k]):
                both = common(sets[i], sets[k])
                if 100 * both >= percent * (len(sets[i]) + len(sets[k]) - both):
                    links.append((reps[i], reps[k]))
                    gone, stays = find(parts[k]), find(parts[i])
                    root[gone] = stays
                    label[label == gone] = stays
    return links


SKETCHED = "id bigint, t1 bigint, t2 bigint, n_shingles bigint, d1 bigint, d2 bigint, sketch binary"


def sketch_documents(docs: DataFrame, width: int) -> DataFrame:
    """``id, t1, t2, n_shingles, d1, d2, sketch`` of rows ``id, t1, t2, text``: set size, 128-bit digest of the set, registers."""

    def sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = kept("words", WordHashes)

        def flush(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
            filled = [i for i, s in enumerate(sets) if len(s)]
            sketches: list[bytes | None] = [None] * len(sets)
            if filled:
                for i, row in zip(filled, registers([sets[i] for i in filled])):
                    sketches[i] = row.tobytes()
            digests = [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in sets]
            columns = [pa.array([key[k] for key in ids], pa.int64()) for k in range(3)] + [pa.array([len(s) for s in sets], pa.int64())]
            columns += [pa.array([d[k] for d in digests], pa.int64()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(sketches, pa.binary())], names=["id", "t1", "t2", "n_shingles", "d1", "d2", "sketch"])

        for batch in batches:
            ids, sets, size = [], [], 0
            for *key, text in zip(*batch.columns):
                ids.append([value.as_py() for value in key])
                sets.append(shingle_set(text.as_py(), width, hashes))
                size += len(sets[-1]) + 1
                if size >= RUN_SHINGLES:
                    yield flush(ids, sets)
                    ids, sets, size = [], [], 0
            if ids:
                yield flush(ids, sets)

    return docs.mapInArrow(sketch_batches, SKETCHED)


def _bucket_entries(classes: DataFrame, rows: int) -> DataFrame:
    """``bucket, band, rep``, one row for each band of each class."""

    def keys(sketches: pa.Array) -> pa.Array:
        table = np.frombuffer(b"".join(sketches.to_pylist()), np.uint16).reshape(len(sketches), REGISTERS)
        flat = band_keys(table, rows).ravel()
        offsets = np.arange(0, len(flat) + 1, REGISTERS // rows, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    keys_of = F.arrow_udf(keys, T.ArrayType(T.LongType()))
    return classes.select("rep", F.posexplode(keys_of("sketch")).alias("band", "bucket"))


def checked_sets(group: pd.DataFrame, width: int) -> dict[int, np.ndarray]:
    """Shingle set of each class of a group; a text that is not the class's own (its id stands twice) is passed over."""
    hashes, sets = kept("words", WordHashes), {}
    for rep, text, digest in zip(group["rep"], group["text"], group["d1"]):
        if rep not in sets:
            found = shingle_set(text, width, hashes)
            if np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64)[0] == digest:
                sets[rep] = found
    return sets


def verify(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``a, b, both, either`` of the distinct pairs ``a, b``: sizes of intersection and union of the full shingle sets.

    ``texts`` has ``rep, text, n_shingles, d1``. The pairs of one ``a`` go in
    groups of bounded size, each with one copy of its text.
    """
    pairs = pairs.select("a", "b").distinct()
    pairs = pairs.join(texts.select(F.col("rep").alias("b"), "n_shingles"), "b")
    groups = pairs.groupBy("a").agg(F.ceil(F.sum("n_shingles") / GROUP_SHINGLES).alias("groups"))
    pairs = pairs.join(groups, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.greatest(F.col("groups"), F.lit(1))).alias("part"))
    pairs = checkpoint_once(pairs)
    wanted = pairs.select(F.col("b").alias("rep"), "a", "part").union(pairs.select(F.col("a").alias("rep"), "a", "part").distinct())
    members = wanted.join(texts.select("rep", "text", "d1"), "rep")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        sets, leader = checked_sets(group, width), group["a"].iloc[0]
        others = [rep for rep in sets if rep != leader and leader in sets]
        both = np.array([common(sets[leader], sets[rep]) for rep in others], np.int64)
        sizes = np.array([len(sets[leader]) + len(sets[rep]) for rep in others], np.int64)
        return pd.DataFrame({"a": np.full(len(others), leader, np.int64), "b": np.array(others, np.int64), "both": both, "either": sizes - both})

    return members.groupBy("a", "part").applyInPandas(compare, "a bigint, b bigint, both bigint, either bigint")


def _blocks(df: DataFrame) -> DataFrame:
    """Rows once for each block they meet: ``low`` and ``high`` name the pair of blocks. ``blocks`` is the number of them."""
    placed = df.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    spread = placed.withColumn("other", F.explode(F.expr("sequence(0, cast(blocks as int) - 1)")))
    return spread.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))


def _inside_families(placed: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links ``a, b`` that join components of one family; ``placed`` has ``rep, family, component, n_shingles``."""
    mixed = placed.groupBy("family").agg(F.min("component").alias("first"), F.max("component").alias("last"), F.sum("n_shingles").alias("n"))
    mixed = mixed.filter("first < last").select("family", F.greatest(F.lit(1), F.ceil(F.col("n") / FAMILY_SHINGLES)).alias("blocks"))
    members = _blocks(placed.drop("n_shingles").join(checkpoint_once(mixed), "family"))
    members = members.join(texts.select("rep", "text", "d1"), "rep")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        sets = checked_sets(group, width)
        facts = group.drop_duplicates("rep").set_index("rep").loc[list(sets)]
        links = family_links(list(sets), list(facts["component"]), list(facts["block"]), list(sets.values()), percent) if sets else []
        return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)

    return members.groupBy("family", "low", "high").applyInPandas(compare, "a bigint, b bigint")


def _across_families(entries: DataFrame, placed: DataFrame, classes: DataFrame, least: float, band_rows: int) -> DataFrame:
    """Pairs ``a, b`` of different families in one bucket that may reach the limit."""
    known = entries.join(placed.select("rep", "family"), "rep")
    mixed = known.groupBy("bucket").agg(F.min("family").alias("first"), F.max("family").alias("last"), F.count("*").alias("n"))
    mixed = mixed.filter("first < last").select("bucket", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    known = _blocks(known.join(checkpoint_once(mixed), "bucket")).drop("other", "blocks")
    known = known.join(classes.select("rep", "n_shingles", "sketch"), "rep")
    keys = ["bucket", "low", "high"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def pairs(rows: pd.DataFrame) -> pd.DataFrame:
            i, j = likely_pairs(rows, least, band_rows)
            a, b = rows["rep"].to_numpy()[i], rows["rep"].to_numpy()[j]
            return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            # The last group may go on in the next batch.
            last = (held[keys] == held[keys].iloc[-1]).all(axis=1).to_numpy()
            yield pairs(held[~last])
            held = held[last]
        if held is not None:
            yield pairs(held)

    sorted_rows = known.repartition(*keys).sortWithinPartitions(*keys)
    return sorted_rows.mapInPandas(compare, "a bigint, b bigint")


def text_key(text: Column) -> list[Column]:
    """``t1, t2``: 128-bit key of a text, null as empty."""
    body = F.coalesce(text, F.lit(""))
    return [F.xxhash64(body).alias("t1"), F.xxhash64(F.lit(7), body).alias("t2")]


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row ``id, n_shingles, component_id, kept`` for each row of ``df``.

    Documents whose shingle sets of ``width`` words share at least ``percent``
    per cent of their union are linked; ``component_id`` is the smallest id that
    links reach, and the row with that id is kept. Null and empty texts and
    texts of blanks only have no shingle, are linked with nothing and are kept.

    Ids are whole numbers. Repeated rows are copies of each other and each gets
    a row. Rows without an id are linked like all others; where no id is among
    linked rows, their ``component_id`` is null. Several texts may carry one id.
    Of the texts that carry the smallest id of linked rows, or of those without
    an id where none has one, the rows of one text are kept. Other columns are
    not looked at.
    """
    return judged(df, doc_id, text, width, percent).select("id", "n_shingles", "component_id", "kept")


def judged(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``near_duplicates`` with ``t1, t2``, the key of the row's text; rows of equal id and text are judged alike."""
    if not 50 <= percent <= 100 or width < 1:
        raise ValueError("percent must be from 50 to 100 and width at least 1")
    body = F.col(f"`{text}`")
    docs = df.select(F.col(f"`{doc_id}`").cast("bigint").alias("id"), *text_key(body), body.alias("text"))
    sketched = checkpoint_once(sketch_documents(docs, width))
    filled = sketched.filter("n_shingles > 0")
    # The row that stands for a class: the smallest id, those without one last, then the key of the text.
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "t1", "t2")).alias("first")
    named = filled.groupBy("d1", "d2").agg(first).select("d1", "d2", "first.*")
    # A number of its own for each class; it is stored, so it stays.
    named = checkpoint_once(named.withColumn("rep", F.monotonically_increasing_id()))
    # Copies without an id are combined before they are shuffled; the others have their id as a key.
    keys = ["d1", "d2", "t1", "t2"]
    stand = filled.filter("id is not null").join(named.filter("id is not null"), [*keys, "id"]).drop("id", "no_id")
    bare = filled.filter("id is null").drop("id").dropDuplicates(keys)
    stand = stand.unionByName(bare.join(named.filter("id is null").drop("id", "no_id"), keys))
    classes = checkpoint_once(stand.groupBy("rep").agg(*[F.first(c).alias(c) for c in ("n_shingles", "d1", "sketch")]))

    entries = _bucket_entries(classes, rows_for(percent))
    shared = entries.groupBy("bucket").agg(F.min("rep").alias("leader"), F.max("rep").alias("last"))
    shared = checkpoint_once(shared.filter("leader < last").select("bucket", "leader"))
    entries = checkpoint_once(entries.join(shared, "bucket"))
    inside = entries.select("rep").distinct()
    facts = classes.join(inside, "rep").select("rep", "n_shingles", "d1")
    wanted = facts.join(named.select("rep", "id", "t1", "t2"), "rep")
    without = docs.filter("id is null").select("t1", "t2", "text").distinct()
    texts = wanted.filter("id is not null").join(docs.filter("id is not null"), ["id", "t1", "t2"]).select(*facts.columns, "text")
    texts = checkpoint_once(texts.union(wanted.filter("id is null").join(without, ["t1", "t2"]).select(*facts.columns, "text")))

    led = entries.filter("leader <> rep").groupBy("rep", "leader").count()
    led = led.groupBy("rep").agg(F.max(F.struct("count", -F.col("leader"))).alias("best"))
    checked = verify(led.select((-F.col("best.col2")).alias("a"), F.col("rep").alias("b")), texts, width)
    checked = checkpoint_once(checked.withColumn("linked", 100 * F.col("both") >= percent * F.col("either")))
    links = checked.filter("linked").select("a", "b")
    near = checked.filter(F.col("both") >= (percent / 100 - FAMILY_MARGIN) * F.col("either"))
    placed = facts.select("rep", "n_shingles")
    for name, found in (("component", links), ("family", near)):
        placed = placed.join(connected_components(found.select("a", "b")).toDF("rep", name), "rep", "left")
        placed = placed.withColumn(name, F.coalesce(name, "rep"))
    placed = checkpoint_once(placed)

    inside = _inside_families(placed, texts, width, percent)
    across = verify(_across_families(entries.select("bucket", "band", "rep"), placed, classes, percent / 100 - MARGIN, rows_for(percent)), texts, width)
    across = across.filter(100 * F.col("both") >= percent * F.col("either")).select("a", "b")
    parts = connected_components(links.union(inside).union(across)).withColumnRenamed("node", "rep")

    named = checkpoint_once(named.join(parts, "rep", "left").withColumn("component", F.coalesce("component", "rep")))
    # Combined before they are shuffled, whatever the size of a component.
    kept_of = parts.join(named.drop("component"), "rep").groupBy("component").agg(F.min(F.struct("no_id", "id", "t1", "t2")).alias("best"))
    own = F.struct("no_id", "id", "t1", "t2")
    named = named.join(kept_of, "component", "left").withColumn("best", F.coalesce("best", own))
    named = named.select("d1", "d2", F.col("best.id").alias("component_id"), F.col("best.t1").alias("k1"), F.col("best.t2").alias("k2"))
    joined = sketched.drop("sketch").join(checkpoint_once(named), ["d1", "d2"], "left")
    empty = F.col("n_shingles") == 0
    chosen = F.col("id").eqNullSafe(F.col("component_id")) & (F.col("t1") == F.col("k1")) & (F.col("t2") == F.col("k2"))
    component = F.when(empty, F.col("id")).otherwise(F.col("component_id"))
    return joined.select("id", "t1", "t2", "n_shingles", component.alias("component_id"), (empty | chosen).alias("kept"))
