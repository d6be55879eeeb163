"""Near-duplicate documents by HyperMinHash sketches, confirmed on full shingle sets.

1. Every text becomes its set of distinct word shingles (64-bit hashes). The sketch keeps
   for each bucket the smallest hash as leading-zero count and leading mantissa bits.
   Texts of equal sets are one class, whatever their number.
2. Bands of registers are bucket keys. In each bucket the members are linked to one
   centre (no pairs), the collision-corrected Jaccard estimate of the sketches drops the
   hopeless, and full sets decide. Empty registers of short texts are filled from others.
3. Buckets that still hold several components and share a pivot, the best linked node of the
   largest component there, are one family. Its members are compared with the pivot, and
   then, where the triangle inequality of the Jaccard distance to the pivot leaves it open, with
   each other on full sets, in blocks of bounded size that give out true links only.
4. Components by alternating large-star and small-star steps over tables.

Defined results: a text without words is linked with nothing; fewer words than a shingle
form one shingle; repeated rows are one class; a null id is a row like others (its class
takes the smallest id that is not null); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualia.llm.shared import plain_names, ship, staged
from qualia.llm.textops import BASE, NON_SPACE, U64, mix64, span_hashes, text_slices, word_spans

SHINGLE = 5
#: Registers of a band, bands, and mantissa bits of a register.
ROWS, BANDS, MANTISSA = 3, 32, 10
#: Share of registers in which unequal sets of like size agree by chance: 0.1699 / 2**MANTISSA.
CHANCE = 0.169919487159739093975 / 2**MANTISSA
#: Standard deviations by which an estimate may fall short of the threshold.
SLACK = 5.0
#: Rows of a part of a family; larger families are compared part against part.
BLOCK_ROWS = 256


def shingle_sets(col: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, _, data, off in text_slices(col):
        s, e, first = word_spans(data, off, NON_SPACE)
        w = span_hashes(data, s, e)
        n = len(w)
        run = np.zeros(n, U64)
        with np.errstate(over="ignore"):
            for k in range(min(size, n)):  # a run that reaches into the next text is not used
                run[:n - k] = run[:n - k] * BASE + w[k:]
            full = mix64(run)
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                if b - a >= size:
                    yield np.unique(full[a:b - size + 1])
                elif b > a:
                    h = U64(b - a)
                    for x in w[a:b]:
                        h = h * BASE + x
                    yield mix64(np.array([h], U64))
                else:
                    yield np.zeros(0, U64)


def registers(hashes: np.ndarray, n: int) -> np.ndarray:
    """HyperMinHash registers of a sorted set: 0 if empty, else (leading zeros + 1, mantissa)."""
    low = np.zeros(n, U64)
    full = np.zeros(n, bool)
    at = (hashes % U64(n)).astype(np.int64)[::-1]
    low[at] = hashes[::-1]  # the smallest comes last
    full[at] = True
    top = np.frexp(np.maximum(low, U64(1)).astype(np.float64))[1].astype(np.int64) - 1
    top -= (low >> np.minimum(top, 63).astype(U64)) == 0  # the float was rounded up
    zeros = np.minimum(63 - top, 61)
    rest = (low << (zeros + 1).astype(U64)) >> U64(64 - MANTISSA)
    return np.where(full, ((zeros + 1) << MANTISSA) | rest.astype(np.int64), 0).astype(np.uint16)


def filled(regs: np.ndarray) -> np.ndarray:
    """Registers (a row each set) whose empty buckets take the value of another bucket of the set, in an order fixed for
    each bucket, so that bands of short texts tell as much as those of long ones."""
    out, n = regs.copy(), regs.shape[1]
    row, col = np.nonzero((regs == 0) & (regs != 0).any(1)[:, None])
    turn = 0
    while len(row):
        turn += 1
        other = (mix64((col * 4096 + turn % 4096).astype(U64) + U64(turn // 4096 << 32)) % U64(n)).astype(np.int64)
        got = regs[row, other]
        out[row, col] = got
        left = got == 0
        row, col = row[left], col[left]
    return out


def _sketcher(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = ROWS * BANDS
        tag = (np.arange(BANDS, dtype=np.int64) << 48)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                count, digest, regs = [], [], []
                for h in shingle_sets(part.column(1), size):
                    count.append(len(h))
                    digest.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                    regs.append(registers(h, n))
                r = filled(np.array(regs, np.uint16).reshape(-1, n)).reshape(-1, BANDS, ROWS).astype(np.int64)
                key = (r[:, :, 0] << 32) | (r[:, :, 1] << 16) | r[:, :, 2]
                key = np.where(key > 0, key | tag, -1).ravel()
                bands = pa.ListArray.from_arrays(np.arange(0, len(key) + 1, BANDS, dtype=np.int32), pa.array(key))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(count, pa.int64()), pa.array(digest, pa.binary()), bands],
                                                 ["id", "mark", "n", "node", "bands"])
    return run


def text_mark(text_col: str) -> Column:
    """Digest of a text: with the id it names a row, up to rows of the same id and text."""
    return F.unhex(F.sha2(text_col, 256))


def sketch(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, mark: digest of the text, n shingles, node: digest of the set or null, bands: the registers by band)."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), text_mark(text_col).alias("mark"))
    return docs.mapInArrow(_sketcher(size), "id long, mark binary, n long, node binary, bands array<long>")


def _estimate(a: str, b: str) -> str:
    """SQL: registers that agree and registers in use of two sketches, as a struct (m, u)."""
    return f"""aggregate(sequence(0, {BANDS - 1}), named_struct('m', 0, 'u', 0), (s, i) -> named_struct(
        'm', s.m + {' + '.join(_register(a, b, k)[0] for k in range(ROWS))},
        'u', s.u + {' + '.join(_register(a, b, k)[1] for k in range(ROWS))}))"""


def _register(a: str, b: str, k: int) -> tuple[str, str]:
    part = f"(shiftright(greatest({{}}[i], 0L), {16 * (ROWS - 1 - k)}) & 65535L)"
    x, y = part.format(a), part.format(b)
    return f"if({x} > 0 and {x} = {y}, 1, 0)", f"if({x} > 0 or {y} > 0, 1, 0)"


def _comparer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, shared, total) of pairs with the sets' bytes."""
    for batch in batches:
        shared, total = [], []
        for x, y in zip(batch.column(2), batch.column(3)):
            both = np.concatenate([np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)])
            both.sort()
            n = int((both[1:] == both[:-1]).sum())
            shared.append(n)
            total.append(len(both) - n)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared, pa.int64()), pa.array(total, pa.int64())], ["a", "b", "shared", "total"])


def _block_links(num: int, den: int):
    """Links between different components inside each group of rows (sorted by family, i, j), one for
    each row and component. In a block (i, j) with i < j only pairs over both parts are looked at.

    A row is passed over for partners whose distance from the family's pivot differs by more than the
    Jaccard distance allowed (a metric, so such a pair can't be near enough); the others are counted on full sets.
    """
    limit = 1 - num / den + 1e-9

    def of_group(part: np.ndarray, cross: bool, comp: np.ndarray, far: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        some = np.flatnonzero(part == part.min())
        rest = np.flatnonzero(part != part.min()) if cross else some
        if not len(rest) or len(np.unique(comp)) < 2:
            return []
        known, ids = np.unique(np.concatenate(sets), return_inverse=True)
        size = np.array([len(x) for x in sets])
        at = np.cumsum(size) - size
        other = np.concatenate([ids[at[y]:at[y] + size[y]] for y in rest])
        starts = np.cumsum(size[rest]) - size[rest]
        flag = np.zeros(len(known), np.int64)
        out = []
        for x in some.tolist():
            ok = (comp[rest] != comp[x]) & ~(np.abs(far[rest] - far[x]) > limit)
            if not cross:
                ok &= rest > x
            if not ok.any():
                continue
            own = ids[at[x]:at[x] + size[x]]
            flag[own] = 1
            shared = np.add.reduceat(flag[other], starts)
            flag[own] = 0
            near = np.flatnonzero(ok & (den * shared >= num * (size[rest] + size[x] - shared)))
            if len(near):
                _, first = np.unique(comp[rest[near]], return_index=True)
                out += [(x, y) for y in rest[near[first]].tolist()]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(table: pa.Table) -> pa.RecordBatch:
            i, j, part, far = (table[c].to_numpy() for c in ("i", "j", "part", "far"))
            comp = table["comp"].combine_chunks().dictionary_encode().indices.to_numpy()
            edges = np.append(np.flatnonzero(changes(table)), table.num_rows)
            hashes, node = table["hashes"].combine_chunks(), table["node"].combine_chunks()
            pairs = []
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                p = slice(lo, hi)
                sets = [np.frombuffer(hashes[k].as_buffer(), U64) for k in range(lo, hi)]
                pairs += [(x + lo, y + lo) for x, y in of_group(part[p], bool(i[lo] != j[lo]), comp[p], far[p], sets)]
            a, b = pa.array([x for x, _ in pairs], pa.int64()), pa.array([y for _, y in pairs], pa.int64())
            return pa.RecordBatch.from_arrays([node.take(a), node.take(b)], ["a", "b"])

        def changes(table: pa.Table) -> np.ndarray:
            keys = [table["family"].combine_chunks().dictionary_encode().indices.to_numpy(), table["i"].to_numpy(), table["j"].to_numpy()]
            new = np.ones(table.num_rows, bool)
            new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
            return new

        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            last = int(np.flatnonzero(changes(table))[-1]) if table.num_rows else 0  # the last group may go on
            if last:
                yield done(table.slice(0, last))
            held = table.slice(last)
        if held is not None and held.num_rows:
            yield done(held)
    return run


def _setter(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                sets = list(shingle_sets(part.column(1), size))
                node = [hashlib.blake2b(h.tobytes(), digest_size=16).digest() for h in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(node, pa.binary()), pa.array([h.tobytes() for h in sets], pa.binary())],
                                                 ["want", "node", "hashes"])
    return run


class Matcher:
    """Candidate pairs to confirmed links for one table of documents."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, size: int, num: int, den: int):
        self.size, self.num, self.den = size, num, den
        self.docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), text_mark(text_col).alias("mark"))
        sketched = staged(sketch(docs, id_col, text_col, size), "neardup-sketch")
        self.rows = sketched.select("id", "mark", "n", "node")
        self.nodes = staged(sketched.where("node is not null").groupBy("node").agg(
            F.min("id").alias("id"), F.min(F.struct(F.col("id").isNull(), "id", "mark")).alias("row"), F.first("n").alias("n"), F.first("bands").alias("bands")), "neardup-nodes")
        every = self.nodes.select("node", F.explode("bands").alias("key")).where("key >= 0")
        # least and largest of each bucket by a pre-aggregated group-by: a bucket of any size is joined back in parts
        bucket = every.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z")
        self.keys = staged(every.join(bucket.select("key", "a"), "key"), "neardup-keys")

    def stars(self) -> DataFrame:
        """In each bucket, every member with the smallest one."""
        return self.keys.where("a < node").selectExpr("a", "node b").distinct()

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sizes and sketches allow the similarity."""
        t = self.num / self.den
        n = self.nodes.select("node", "n", "bands")
        both = (pairs.join(n.selectExpr("node a", "n na", "bands ra"), "a").join(n.selectExpr("node b", "n nb", "bands rb"), "b")
                .where(f"{self.den} * least(na, nb) >= {self.num} * greatest(na, nb)")
                .withColumn("s", F.expr(_estimate("ra", "rb"))))
        j = f"((s.m / s.u - {CHANCE}) / (1 - {CHANCE}))"
        return both.where(f"{j} >= {t} - {SLACK} * sqrt({t * (1 - t)} / least(na, nb, s.u))").select("a", "b")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """(node, hashes: the full set) of different nodes; written once."""
        need = nodes.join(self.nodes.select("node", "row"), "node").selectExpr("row.id id", "row.mark need", "node want")
        # a null id cannot be joined back by plain equality, nor alone: ids may be null or stand several times
        same = F.col("doc").eqNullSafe(F.col("id")) & F.col("mark").eqNullSafe(F.col("need"))
        texts = self.docs.withColumnRenamed("id", "doc").join(need, same).select("want", "text")
        sets = texts.mapInArrow(_setter(self.size), "want binary, node binary, hashes binary").where("want = node")
        return staged(sets.dropDuplicates(["node"]).select("node", "hashes"), "neardup-sets")

    def compared(self, pairs: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        """(a, b, shared, total) of different pairs of nodes, on full sets; written once."""
        pairs = staged(pairs, "neardup-pairs")
        if sets is None:
            sets = self.sets(pairs.selectExpr("a node").union(pairs.selectExpr("b node")).distinct())
        a, b = sets.selectExpr("node a", "hashes ha"), sets.selectExpr("node b", "hashes hb")
        both = pairs.join(a, "a").join(b, "b").select("a", "b", "ha", "hb")
        return staged(both.mapInArrow(_comparer, "a binary, b binary, shared long, total long"), "neardup-compared")

    def links(self, compared: DataFrame) -> DataFrame:
        return compared.where(f"{self.den} * shared >= {self.num} * total").select("a", "b")

    def open_buckets(self, comp: DataFrame) -> DataFrame:
        """(key, node, comp) of the buckets that hold several components; in those of two members the pair was compared."""
        rows = staged(self.keys.select("key", "node").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "neardup-key-comp")
        bucket = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("members"))
        return rows.join(bucket.where("lo < hi and members > 2").select("key"), "key").select("key", "node", "comp")

    def pivots(self, links: DataFrame, comp: DataFrame, rows: DataFrame) -> DataFrame:
        """(key, pivot): for each open bucket with linked members, the best linked node of its largest component."""
        degree = links.selectExpr("a node").union(links.selectExpr("b node")).groupBy("node").agg(F.count("*").alias("links"))
        hub = comp.join(degree, "node").groupBy("comp").agg(F.max(F.struct("links", "node")).alias("hub"), F.count("*").alias("size"))
        hub = hub.select("comp", F.col("hub.node").alias("pivot"), "size")
        held = rows.select("key", "comp").join(hub, "comp")  # of rows that repeat the largest is the same
        return held.groupBy("key").agg(F.max(F.struct("size", "pivot")).alias("p")).select("key", "p.pivot")

    def rest(self, rows: DataFrame, sets: DataFrame) -> DataFrame:
        """Links between components of a family, found in blocks of bounded size. rows: (family, node, comp, distance).

        A component of more than BLOCK_ROWS rows has parts of its own, smaller ones share theirs. A part meets the other
        parts of its family, but for those of its own large component, so rows that are linked already cost nothing.
        """
        several = rows.groupBy("family").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("family")
        rows = rows.join(several, "family")
        size = rows.groupBy("family", "comp").agg(F.count("*").alias("n"))
        size = size.withColumn("own", F.expr(f"if(n > {BLOCK_ROWS}, comp, NULL)"))
        parts = size.groupBy("family", "own").agg(F.expr(f"(sum(n) - 1) div {BLOCK_ROWS} + 1").alias("parts"))
        rows = rows.join(size.select("family", "comp", "own"), ["family", "comp"])
        rows = rows.alias("r").join(parts.alias("p"), F.expr("r.family = p.family and r.own <=> p.own")).selectExpr("r.*", "pmod(xxhash64(r.node), p.parts) k")
        other = parts.selectExpr("family f", "own other_own", "explode(sequence(0L, parts - 1)) other_k")
        rows = rows.join(other, F.expr("family = f and (own is null or other_own is null or own <> other_own)"))
        rows = rows.withColumns({"part": F.xxhash64("own", "k"), "other": F.xxhash64("other_own", "other_k")})
        rows = rows.selectExpr("family", "least(part, other) i", "greatest(part, other) j", "part", "node", "comp", "coalesce(distance, double('nan')) far")
        rows = rows.join(sets, "node").repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")
        return rows.mapInArrow(_block_links(self.num, self.den), "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(node, comp: smallest node reachable) for every node of the links (a, b), by star contraction."""
    edges = staged(links.selectExpr("least(a, b) a", "greatest(a, b) b").where("a < b").distinct(), "cc")
    while True:
        # large star: neighbours above a node go to the smallest of its neighbourhood
        both = edges.union(edges.selectExpr("b a", "a b"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").selectExpr("m a", "b").where("a < b").distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(low, "b").selectExpr("m a", "a b").union(low.selectExpr("m a", "b"))).where("a < b").distinct()
        new = staged(small, "cc")
        changed = new.select("a", "b").exceptAll(edges.select("a", "b")).isEmpty() and edges.select("a", "b").exceptAll(new.select("a", "b")).isEmpty()
        edges = new
        if changed:
            break
    return edges.selectExpr("b node", "a comp").union(edges.selectExpr("a node", "a comp")).distinct()


def _families(m: Matcher) -> DataFrame:
    """(node, comp: smallest node reachable) for the nodes with links."""
    first = m.compared(m.likely(m.stars()))
    links = m.links(first)
    comp = staged(components(links), "neardup-comp")
    # open buckets with one pivot are a family: every member is compared with the pivot, then inside the family
    rows = staged(m.open_buckets(comp), "neardup-open")
    rows = rows.join(m.pivots(links, comp, rows), "key", "left")
    rows = staged(rows.select(F.coalesce("pivot", F.col("key").cast("string").cast("binary")).alias("family"), "pivot", "node").distinct(), "neardup-family")
    sets = m.sets(rows.select("node").union(rows.where("pivot is not null").select("pivot")).distinct())
    near = m.compared(rows.where("node <> pivot").selectExpr("least(node, pivot) a", "greatest(node, pivot) b").distinct(), sets)
    links = links.union(m.links(near)).distinct()
    comp = staged(components(links), "neardup-comp")
    d = near.selectExpr("a", "b", "1 - shared / total distance")
    far = d.union(d.selectExpr("b a", "a b", "distance")).selectExpr("a node", "b pivot", "distance").distinct()
    rows = rows.join(far, ["node", "pivot"], "left").join(comp, "node", "left").select(
        "family", "node", F.coalesce("comp", "node").alias("comp"), F.when(F.col("node") == F.col("pivot"), 0.0).otherwise(F.col("distance")).alias("distance"))
    more = staged(m.rest(rows, sets), "neardup-more")
    if not more.isEmpty():
        comp = staged(components(links.union(more)), "neardup-comp")
    return comp


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    similarity: tuple[int, int] = (75, 100)) -> DataFrame:
    """One row per document: id, n_shingles, component (smallest id reachable; its own for a text without words)."""
    m = Matcher(docs, id_col, text_col, size, *similarity)
    comp = _families(m)
    named = m.nodes.join(comp, "node", "left").select("node", "id", F.coalesce("comp", "node").alias("comp"))
    least = named.groupBy("comp").agg(F.min("id").alias("component"))
    by_node = named.join(least, "comp").select("node", "component")
    return m.rows.select("id", "n", "node").join(by_node, "node", "left").select(
        "id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                         similarity: tuple[int, int] = (75, 100)) -> DataFrame:
    """One row of each component, that of the smallest id (null last), and every row without words; same columns.

    Ids need not be unique: a row goes only if a row kept has the same set or is linked with it.
    """
    plain, name = plain_names(docs)
    key, text = name[id_col], name[text_col]
    m = Matcher(plain, key, text, size, *similarity)
    rows = m.rows.where("node is not null").join(_families(m), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    best = rows.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "node", "mark")).alias("best"))
    best = best.selectExpr("best.id _kept", "best.mark _kept_mark")
    worded = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    with_words = plain.where(worded).withColumn("_mark", text_mark(text))
    same = F.col(key).cast("long").eqNullSafe(F.col("_kept")) & (F.col("_mark") == F.col("_kept_mark"))
    kept = with_words.join(best, same, "left_semi").dropDuplicates([key, "_mark"])  # one of the rows of that id and text
    return kept.select(*plain.columns).union(plain.where(~worded)).toDF(*docs.columns)
