"""MinHash near-dedup with HyperMinHash registers (operator 2).

Every document becomes a set of hashed word shingles, of SHINGLE words unless the caller says otherwise. Documents with
equal sets form a class; only its smallest document goes on. A sketch has REGISTERS buckets. A bucket's minimum is stored as a leading-zero count and a few
mantissa bits behind the leading one, two bytes in all. Bands of registers give candidates; the estimated Jaccard
similarity of two sketches, corrected for registers that agree by chance, drops most false ones; the rest are
confirmed on whole shingle sets.

Buckets take their minima under hash functions of their own rather than from a partition of one hash: short texts
would leave most buckets of a partition empty, and a band of empty buckets says nothing. What makes the sketch a
HyperMinHash is the register, a leading-zero count and a few mantissa bits, and the correction for registers that agree
by chance; both are the same whether the buckets' hashes are parts of one function or functions of their own.

Candidates within a bucket of a band are the pairs with its smallest member, then the pairs that lie in different
components so far. Those have a member outside the bucket's largest component; such members are compared with all
others block by block inside a task, and come out as links only. So a bucket of near copies costs a row per member, and
nothing is dropped where a bucket holds texts that are alike but no links. A bucket of S members of which M are outside
the largest component sends S * M * (1 / MINORS + 1 / OTHERS) rows at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import checked, free_name, made, staged, sweep, with_ids, word_list
from foliant.llm.components import components
from foliant.session import ship_package

#: Words of a shingle in op2_minhash.
SHINGLE = 2
PERCENT = 80
ROWS = 4
BANDS = 32
REGISTERS = ROWS * BANDS
#: A register is LEADING bits of leading-zero count and MANTISSA bits.
MANTISSA = 10
#: Estimated similarity below which a candidate pair isn't verified: five standard errors under 0.8 for 128 registers.
ESTIMATE = 0.62
#: Members of a bucket that one block holds: those outside its largest component, and all that they are compared with.
MINORS, OTHERS = 512, 1024
#: Pairs of one document that a task should have; a document with more is dealt to several.
HUB = 1000
MEMO = 100_000
#: Shingles hashed at once, so that the products stay in the cache.
CHUNK = 256

_RNG = np.random.default_rng(20_240_229)
_A = _RNG.integers(1, 2**63, REGISTERS, dtype=np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 2**63, REGISTERS, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHash(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, hashes: WordHash, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles of a whole text.

    With fewer than n words the whole sequence is the one shingle; without words the set is empty. Two different shingles
    share a hash with probability 2 ** -64.
    """
    words = word_list(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(n, len(h))
    out = h[: len(h) - size + 1].copy()
    for k in range(1, size):
        out ^= out >> np.uint64(31)
        out *= _MIX
        out += h[k : len(h) - size + 1 + k]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    if len(words) < n:
        out ^= np.uint64(len(words))
    return np.unique(out)


def registers(items: np.ndarray, work: np.ndarray) -> np.ndarray:
    """The compressed sketch of a non-empty set, as REGISTERS numbers of two bytes; work is a REGISTERS x CHUNK buffer."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(items), CHUNK):
        part = items[i : i + CHUNK]
        hashed = work[:, : len(part)]
        np.multiply(_A[:, None], part, out=hashed)
        hashed += _B[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    return compress(least)


def compress(least: np.ndarray) -> np.ndarray:
    """Leading zeros (at most 63) and the MANTISSA bits behind the leading one."""
    top = np.frexp(least.astype(np.float64))[1].astype(np.int64)  # position of the leading one, from 1
    # The float may round up to the next power of two; then the true leading one is a bit lower.
    top = np.where((top > 0) & (np.right_shift(least, np.maximum(top - 1, 0).astype(np.uint64)) == 0), top - 1, top)
    zeros = np.clip(64 - top, 0, 63)
    shifted = np.left_shift(least, np.minimum(zeros + 1, 63).astype(np.uint64))
    mantissa = np.right_shift(shifted, np.uint64(64 - MANTISSA))
    return ((zeros.astype(np.uint64) << np.uint64(MANTISSA)) | mantissa).astype("<u2")


def chance(n: np.ndarray | float, m: np.ndarray | float) -> np.ndarray:
    """Probability that one register of two unrelated sets of n and m items agrees.

    The minimum of n uniform hashes is nearly exponential with rate n. Two such minima fall in one cell of width w at x
    with probability n m w**2 exp(-(n + m) x); summed over the cells of each octave.
    """
    n, m = np.asarray(n, float), np.asarray(m, float)
    total = np.zeros(np.broadcast(n, m).shape)
    cells = 1 << MANTISSA
    for zeros in range(64):
        low = 2.0 ** -(zeros + 1)
        w = low / cells
        total += n * m * w * (np.exp(-(n + m) * low) - np.exp(-2 * (n + m) * low)) / (n + m)
    return np.minimum(total, 0.5)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity of sketches (rows of registers), corrected for collisions of unrelated registers."""
    same = (a == b).mean(axis=-1)
    by_chance = chance(n, m)
    return (same - by_chance) / (1 - by_chance)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One signed 64-bit key per band; the band's number is mixed in."""
    quads = np.ascontiguousarray(sketch).view("<u8").astype(np.uint64)
    keys = (quads ^ (np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * _MIX
    keys ^= keys >> np.uint64(32)
    keys *= np.uint64(0xD6E8FEB86659FD93)
    return keys.view(np.int64)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Sorted distinct shingles of two texts: 100 * intersection >= PERCENT * union, by whole numbers."""
    if not len(a) or not len(b):
        return False
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def sketches(docs: DataFrame, key: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, tag, n, digest, sketch) per row of docs; tag is a hash of the text, digest identifies the set, and the last two
    are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, work = WordHash(), np.empty((REGISTERS, CHUNK), np.uint64)
        for batch in batches:
            n, digest, sketch = [], [], []
            for x in batch.column(2):
                s = shingles(x.as_py(), hashes, shingle)
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sketch.append(registers(s, work).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sketch, pa.binary())], ["id", "tag", "n", "digest", "sketch"])

    ship_package(docs.sparkSession)
    return _texts(docs, key, text).select("id", "tag", "text").mapInArrow(run, "id long, tag long, n long, digest binary, sketch binary")


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, tag, text) of docs."""
    return docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("tag"), F.col(text).alias("text"))


def bands(classes: DataFrame) -> DataFrame:
    """(band, id): BANDS rows per class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, REGISTERS)
            for i in range(0, len(rows), 1000):
                keys = np.concatenate([band_keys(r) for r in rows[i : i + 1000]])
                ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False)[i : i + 1000], BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids, pa.int64())], ["band", "id"])

    return classes.select("id", "sketch").mapInArrow(run, "band long, id long")


def _dealt(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) with a number salt, so that no (b, salt) has many more than HUB pairs."""
    hubs = staged(pairs.groupBy("b").count().where(F.col("count") > HUB).select("b", F.ceil(F.col("count") / HUB).cast("int").alias("splits")))
    return pairs.join(checked(hubs), "b", "left").select("a", "b", F.coalesce(F.pmod(F.xxhash64("a"), F.col("splits")), F.lit(0)).cast("int").alias("salt"), F.coalesce("splits", F.lit(1)).alias("splits"))


def _hubs(dealt: DataFrame) -> DataFrame:
    """(b, salt) of dealt pairs, each once."""
    each = dealt.groupBy("b").agg(F.max("splits").alias("splits"))
    return each.select("b", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("salt"))


def likely(dealt: DataFrame, classes: DataFrame) -> DataFrame:
    """The dealt pairs whose sketches are estimated to be similar enough to be verified."""
    side = classes.select("id", "n", "sketch")
    hubs = _hubs(dealt).join(side.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
    both = dealt.join(side.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a").join(hubs, ["b", "salt"])
    # Sizes alone already bound the similarity.
    both = both.where((F.least("na", "nb") * 100) >= (F.greatest("na", "nb") * PERCENT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, REGISTERS) for i in (4, 5))
            n, m = (batch.column(i).to_numpy(zero_copy_only=False) for i in (6, 7))
            yield batch.select([0, 1, 2, 3]).filter(pa.array(estimate(a, b, n, m) >= ESTIMATE))

    return both.select("a", "b", "salt", "splits", "sa", "sb", "na", "nb").mapInArrow(run, "a long, b long, salt int, splits int")


def confirmed(dealt: DataFrame, texts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The dealt pairs that are links on the whole shingle sets of texts (id, text), as (a, b).

    Each text of b goes once to each of its tasks, ahead of the texts that it is compared with.
    """
    first = _hubs(dealt).join(texts, F.col("b") == F.col("id")).select("b", "salt", F.lit(True).alias("lead"), F.col("b").alias("a"), "text")
    rest = dealt.join(texts, F.col("a") == F.col("id")).select("b", "salt", F.lit(False).alias("lead"), "a", "text")
    lined = first.unionByName(rest).repartition("b", "salt").sortWithinPartitions("b", "salt", F.desc("lead"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, hub, own = WordHash(), None, np.empty(0, np.uint64)
        for batch in batches:
            keep = []
            for b, lead, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(4), strict=True):
                found = shingles(text.as_py(), hashes, shingle)
                if lead:
                    hub, own = b, found
                keep.append(not lead and b == hub and linked(found, own))
            yield batch.select([3, 0]).filter(pa.array(keep, pa.bool_()))

    return lined.mapInArrow(run, "a long, b long")


def _facing(group: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Of one pair of blocks of a bucket: (i, others) for the rows that are to be compared here.

    Two members are compared if they lie in different components so far, if their sizes and sketches allow a link, and in
    the first band only that they share, so each pair comes up once over all buckets. Two members that are both outside
    the largest component meet twice; the one time counts when the larger id leads.
    """
    rows = np.frombuffer(b"".join(group["sketch"].to_pylist()), "<u2").reshape(-1, REGISTERS)
    component, n, ids, lead, minor = (group[c].to_numpy() for c in ("component", "n", "id", "lead", "minor"))
    keys = np.array([band_keys(r) for r in rows])
    here = int(np.argmax(keys[0] == group["band"][0].as_py()))
    others = np.flatnonzero(~lead)
    for i in np.flatnonzero(lead):
        hit = others[(component[others] != component[i]) & (np.minimum(n[others], n[i]) * 100 >= np.maximum(n[others], n[i]) * PERCENT)]
        hit = hit[~minor[hit] | (ids[hit] < ids[i])]
        hit = hit[(keys[hit] == keys[i]).argmax(axis=1) == here]
        if len(hit):
            hit = hit[estimate(rows[hit], rows[i], n[hit], n[i]) >= ESTIMATE]
        if len(hit):
            yield i, hit


_OPEN = "band long, x int, y int, lead boolean, minor boolean, id long, component long, n long, sketch binary"


def open_members(buckets: DataFrame, part: DataFrame, classes: DataFrame) -> DataFrame:
    """(_OPEN) members of buckets of several components that may have a link to another component in their bucket.

    Members outside a bucket's largest component lead in blocks of about MINORS, and each such block meets all members in
    blocks of about OTHERS; each pair of blocks is one group, compared as matrices of registers. What comes out are
    members, never pairs.
    """
    members = buckets.join(part.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    sizes = members.groupBy("band", "component").agg(F.count("*").alias("n")).groupBy("band")
    spread = sizes.agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("all"), (F.sum("n") - F.max("n")).alias("minors")).where("minors > 0")
    spread = staged(spread.select("band", "main", F.ceil(F.col("minors") / MINORS).cast("int").alias("xs"), F.ceil(F.col("all") / OTHERS).cast("int").alias("ys")))
    held = members.join(checked(spread), "band").withColumn("minor", F.col("component") != F.col("main"))
    held = held.withColumn("x", F.pmod(F.xxhash64("id"), F.col("xs")).cast("int")).withColumn("y", F.pmod(F.xxhash64("id", F.lit(1)), F.col("ys")).cast("int"))
    leading = held.where("minor").withColumn("y", F.explode(F.sequence(F.lit(0), F.col("ys") - 1))).withColumn("lead", F.lit(True))
    others = held.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("xs") - 1))).withColumn("lead", F.lit(False))
    columns = [c.split()[0] for c in _OPEN.split(", ")]
    dealt = leading.unionByName(others).join(classes.select("id", "n", "sketch"), "id").select(*columns)

    def run(group: pa.Table) -> pa.Table:
        wanted = np.zeros(group.num_rows, bool)
        for i, hit in _facing(group):
            wanted[i] = True
            wanted[hit] = True
        return group.filter(pa.array(wanted))

    return dealt.groupBy("band", "x", "y").applyInArrow(run, _OPEN)


def open_links(members: DataFrame, texts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Links (a, b) among open_members, on whole shingle sets: of each pair of blocks, as many as join its components."""
    both = members.join(texts, "id").select(*(c.split()[0] for c in _OPEN.split(", ")), "text")

    def run(group: pa.Table) -> pa.Table:
        hashes, sets = WordHash(), {}
        ids, component = group["id"].to_pylist(), group["component"].to_pylist()
        root = {c: c for c in component}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        def of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingles(group["text"][i].as_py(), hashes, shingle)
            return sets[i]

        found = []
        for i, hit in _facing(group):
            for j in map(int, hit):
                if find(component[i]) != find(component[j]) and linked(of(i), of(j)):
                    root[find(component[i])] = find(component[j])
                    found.append((max(ids[i], ids[j]), min(ids[i], ids[j])))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return both.groupBy("band", "x", "y").applyInArrow(run, "a long, b long").distinct()


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row per input row: (key, n_shingles, component_id, kept).

    A-Z is lower-cased; a link needs 100 * intersection >= 80 * union of the whole shingle sets. Texts without words have
    no shingles, link with nothing and are kept. component_id is the smallest key reachable by links, the own one
    included. Rows that repeat a key are one document in several rows, all with its
    component; if their texts differ, that of the least digest of its set counts for links. Rows with a null key link with nothing: their
    component_id is null and they are kept. An empty table gives no rows; extra columns are ignored.

    A link of similarity exactly 0.8 shares none of the bands with probability (1 - 0.8 ** 4) ** 32 = 5e-8, and is
    estimated below ESTIMATE with about 1e-6; nothing else is left to chance.
    """
    start = made()
    spark = docs.sparkSession
    per_doc = staged(sketches(docs, key, text, shingle))
    real = per_doc.where(F.col("digest").isNotNull() & F.col("id").isNotNull())
    texts = _texts(docs, key, text)
    repeated = staged(real.groupBy("id").agg(F.min(F.struct("digest", "tag")).alias("own"), F.count("*").alias("rows")).where("rows > 1").select("id", "own"))
    if not repeated.isEmpty():
        # One row of each repeated key goes on, and the text of that row.
        own = checked(repeated)
        single = lambda df, equal: df.join(own.select("id"), "id", "left_anti").unionByName(df.join(own, "id").where(equal).drop("own").dropDuplicates(["id"]))
        real = single(real, (F.col("digest") == F.col("own.digest")) & (F.col("tag") == F.col("own.tag")))
        texts = single(texts, F.col("tag") == F.col("own.tag"))
    texts = texts.select("id", "text")
    # The smallest document of each class of equal sets stands for it.
    heads = real.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("size"))
    several = staged(heads.where("size > 1").select("digest", F.col("id").alias("head")))
    member = staged(real.select("id", "digest").join(several, "digest").where("id <> head").select("id", "head"))
    classes = staged(real.join(member, "id", "left_anti").select("id", "n", "sketch"))
    in_bands = bands(classes)
    shared = in_bands.groupBy("band").agg(F.min("id").alias("low"), F.count("*").alias("size")).where("size > 1")
    buckets = staged(in_bands.join(shared.select("band", "low"), "band"))

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = staged(pairs)
        wanted = staged(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct())
        return staged(confirmed(pairs, with_ids(texts, wanted, "left_semi"), shingle))

    stars = buckets.where("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b")).distinct()
    links = verify(likely(_dealt(staged(stars)), classes))
    part = staged(components(links))
    members = staged(open_members(buckets.select("band", "id"), part, classes))
    wanted = staged(members.select("id").distinct())
    more = staged(open_links(members, with_ids(texts, wanted, "left_semi"), shingle))
    if not more.isEmpty():
        part = staged(components(links.unionByName(more)))
    sweep(spark, start, per_doc, member, part)
    headed = part.select(F.col("node").alias("head"), "component")
    of_members = member.join(headed, "head", "left").select("id", F.coalesce("component", "head").alias("component"))
    of_heads = part.join(member, part.node == member.id, "left_anti").select(F.col("node").alias("id"), "component")
    both = of_members.unionByName(of_heads).groupBy("id").agg(F.min("component").alias("component"))
    out = per_doc.select("id", "n").join(both, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def without_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """docs with the smallest key of each component, all columns kept, whatever their names; only the list of dropped keys
    moves. Rows without words or key stay; rows that repeat a kept key stay as often as they come."""
    name = free_name("dropped", docs.columns)
    dropped = near_groups(docs, key, text, shingle).where(~F.col("kept")).select(F.col(key).alias(name)).distinct()
    return docs.join(checked(staged(dropped)), F.col(f"`{key}`").cast("long") == F.col(name), "left_anti")
