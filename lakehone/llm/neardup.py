"""MinHash near-duplicates: bottom-k sketches of one hash function, inverted lists, union-sketch estimates, exact checks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, components, fresh, hashable, interpreted, materialize, rolled

#: Values that a sketch retains.
K = 32
#: Groups of this many texts that share a retained value (the least, then the next) are gathered around their most typical text, with what has this similarity to it.
HOT, ROUNDS, AROUND = 24, 2, 0.6
#: Buckets of the frequencies that order the retained values: a vector of fixed size.
FREQ = 1 << 18
#: Texts that share a prefix value of their sketches in larger numbers than OFTEN are compared by larger sketches of WIDE values, in lists of at most PART texts a side.
OFTEN, WIDE, PART = 256, 256, 1024
#: Shingles of one side of a block that is compared inside a task.
BLOCK = 200_000
#: Ids of at most this many texts are broadcast; more are joined by a shuffle.
FEW = 2_000_000
SIGMA = 5.0


def shingles(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """The set of hashed shingles, ascending: ASCII lower case, words between ASCII white space."""
    if not text:
        return np.zeros(0, np.int64)
    return np.unique(rolled(hashes.of(text.encode().lower().split()), words).view(np.int64))


def agreeing(k: int, t: float) -> int:
    """How many of k values two sketches share at least, if the sets have similarity t or more (but for SIGMA deviations)."""
    return max(1, math.floor(t * k - SIGMA * math.sqrt(max(0.0, t * (1 - t)) * k)))


def needed(n: int, t: float, k: int) -> int:
    """Retained values that a set of n shares at least with any set of similarity t: exact while both sketches hold whole sets."""
    return math.ceil(t * n - 1e-9) if n <= t * k else agreeing(min(n, k), t)


def bits(s: np.ndarray) -> tuple[int, int]:
    """128 bits: in each bin of values, one bit of the least."""
    if not len(s):
        return 0, 0
    u = s.view(np.uint64)
    u = u[np.argsort(u >> np.uint64(8), kind="stable")]
    bins, first = np.unique(u & np.uint64(127), return_index=True)
    on = bins[(u[first] >> np.uint64(7)) & np.uint64(1) == 1].astype(np.int64)
    out = np.zeros(128, np.uint8)
    out[on] = 1
    a, b = np.packbits(out).view("<i8")
    return int(a), int(b)


def parities(s: np.ndarray) -> tuple[int, ...]:
    """256 bits: in each bin of values, whether their number is odd.  Two sets differ in as many values as bits at least."""
    at = (s.view(np.uint64) >> np.uint64(20) & np.uint64(255)).astype(np.int64)
    return tuple(np.packbits((np.bincount(at, minlength=256) & 1).astype(np.uint8)).view("<i8").tolist())


BITS = ["b0", "b1", "p0", "p1", "p2", "p3"]
BIT_FIELDS = ", ".join(f"{b} long" for b in BITS)


def sketched(docs: DataFrame, words: int, k: int, rows: bool = False) -> DataFrame:
    """doc_id, th (hash of the text), rh (with `rows`: of the whole row), sig (128-bit digest of the set), n, bits and parities, sketch."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, words, hashes) for t in batch.column(3).to_pylist()]
            own = zip(*(bits(s) + parities(s) for s in sets)) if sets else [()] * len(BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array(list(map(len, sets)), pa.int64()), *(pa.array(x, pa.int64()) for x in own), pa.array([s[:k] for s in sets], pa.list_(pa.int64()))], ["doc_id", "th", "rh", "sig", "n", *BITS, "sketch"])

    rh = F.xxhash64(*hashable(docs)) if rows else F.lit(0).cast("long")
    return docs.select("doc_id", F.xxhash64("text").alias("th"), rh.alias("rh"), "text").mapInArrow(run, f"doc_id {kind}, th long, rh long, sig binary, n long, {BIT_FIELDS}, sketch array<long>")


def differing(a: str, b: str, t: str) -> str:
    """SQL: whether two texts a and b may reach similarity t by their sizes, parities and bits.

    Sets of similarity t differ in (1 - t) / (1 + t) of the sum of their sizes at most, and in as many values as
    parities at least: that is exact.  A bin's least value differs with probability 1 - t, its bit with half of that.
    """
    # A decimal literal would round (1 - t) / (1 + t) down and lose pairs that are just similar enough.
    t = f"double({t})"
    p = f"((1 - {t}) / 2)"
    apart = lambda names: "(" + " + ".join(f"bit_count({a}.{x} ^ {b}.{x})" for x in names) + ")"
    return f"least({a}.n, {b}.n) >= {t} * greatest({a}.n, {b}.n) - 1e-6 and {apart(BITS[2:])} <= (1 - {t}) / (1 + {t}) * ({a}.n + {b}.n) + 1e-6 and {apart(BITS[:2])} <= 128 * {p} + {SIGMA} * sqrt(128 * {p} * (1 - {p}))"


class Search:
    """One search over docs; the whole texts are read again for those that some pair needs.

    uid: a unit, which stands for all texts with the same set.
    """

    def __init__(self, docs: DataFrame, words: int, percent: int, k: int = K, hot: int = HOT, rows: bool = False):
        self.docs, self.words, self.percent, self.k, self.hot = docs.select("text"), words, percent, k, hot
        self.t = percent / 100
        self.spark = docs.sparkSession
        self.rows = materialize(sketched(docs, words, k, rows), "sketches")
        alone = math.ceil(percent / (100 - percent)) if percent < 100 else 1 << 62
        classes = self.rows.where("n > 0").groupBy("sig").agg(*(F.first(c).alias(c) for c in ("th", "n", *BITS, "sketch")))
        #: Smaller sets than `alone` are similar only if equal.
        self.units = materialize(classes.where(F.col("n") >= alone).withColumn("uid", F.monotonically_increasing_id()), "units")

    def some(self, df: DataFrame, wanted: DataFrame, key: str, most: int | None = None) -> DataFrame:
        """Rows of df whose key is in wanted (of `most` rows at most, if that is known): without a shuffle of df while wanted is few."""
        wanted = wanted.select(key).distinct()
        if most is None or most > FEW:
            wanted = materialize(wanted, "wanted")
            most = wanted.count()
        return df.join(F.broadcast(wanted) if most <= FEW else wanted, key, "left_semi")

    def hashed(self, texts: DataFrame) -> DataFrame:
        """sig, set of each distinct set of texts (text)."""
        words = self.words

        def run(batches):
            hashes = WordHashes()
            for batch in batches:
                sets = [shingles(t, words, hashes) for t in dict.fromkeys(batch.column(0).to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["sig", "set"])

        return texts.mapInArrow(run, "sig binary, set array<long>").groupBy("sig").agg(F.first("set").alias("set"))

    def sets(self, wanted: DataFrame) -> DataFrame:
        """uid, set for wanted (uid), of the whole texts."""
        known = materialize(self.some(self.units, wanted, "uid").select("uid", "th", "sig"), "known")
        texts = self.some(self.docs.withColumn("th", F.xxhash64("text")), known, "th", known.count()).select("text")
        return self.hashed(texts).join(known.select("uid", "sig"), "sig").select("uid", "set")

    def estimated(self, pairs: DataFrame, t: str, sigma: float = SIGMA) -> DataFrame:
        """Those of pairs (a, b, ...) whose sketch of the union estimates similarity t or more, but for `sigma` deviations; with th and sig of both sides."""
        k = self.k
        pairs = materialize(pairs, "pairs")
        known = self.some(self.units, pairs.select(F.col("a").alias("uid")).union(pairs.select("b")), "uid", 2 * pairs.count()).select("uid", "sketch", "th", "sig")
        side = lambda c: known.withColumnsRenamed({"uid": c, "sketch": f"s_{c}", "th": f"th_{c}", "sig": f"sig_{c}"})
        joined = pairs.join(side("a"), "a").join(side("b"), "b")
        union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, k)
        both = F.size(F.array_intersect(union, F.array_intersect("s_a", "s_b")))
        wide = F.expr(f"double({t}) - {sigma} * sqrt(double({t}) * (1 - double({t})) / {k})")
        return joined.where(both / F.size(union) >= wide).select(*pairs.columns, "th_a", "th_b", "sig_a", "sig_b")

    def exact(self, pairs: DataFrame) -> DataFrame:
        """Pairs of estimated() with common and united, the exact sizes of intersection and union."""
        pairs = materialize(pairs, "pairs")
        wanted = pairs.select(F.col("th_a").alias("th")).union(pairs.select("th_b"))
        texts = self.some(self.docs.withColumn("th", F.xxhash64("text")), wanted, "th", 2 * pairs.count()).select("text")
        sets = materialize(self.hashed(texts), "sets")
        joined = pairs.join(sets.withColumnsRenamed({"sig": "sig_a", "set": "set_a"}), "sig_a").join(sets.withColumnsRenamed({"sig": "sig_b", "set": "set_b"}), "sig_b")
        names = [c for c in pairs.columns if c not in ("th_a", "th_b", "sig_a", "sig_b")]
        fields = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in names) + ", common long, united long"

        def run(batches):
            for batch in batches:
                common, united = [], []
                for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                    x, y = x.values.to_numpy(), y.values.to_numpy()
                    common.append(len(np.intersect1d(x, y, assume_unique=True)))
                    united.append(len(x) + len(y) - common[-1])
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(common, pa.int64()), pa.array(united, pa.int64())], [*names, "common", "united"])

        return materialize(joined.select(*names, "set_a", "set_b").mapInArrow(run, fields), "exact")

    def groups(self) -> DataFrame | None:
        """uid, hub, common, united, member: texts around hubs.

        A hub is the text whose retained values are most frequent among those that share one of them, if HOT or more do.  Each text is
        compared with one hub a round, so a group of any size takes work in proportion.  Members are linked with their
        hub; the other texts have similarity AROUND with it at least.
        """
        found = None
        left = self.units
        for r in range(ROUNDS):
            keyed = left.where(F.size("sketch") > r).withColumn("anchor", F.get("sketch", F.lit(r)))
            large = keyed.groupBy("anchor").count().where(F.col("count") >= self.hot)
            group = materialize(self.some(keyed, large, "anchor").select("anchor", "uid", "n", *BITS, "sketch"), "group")
            if group.isEmpty():
                break
            values = group.select("anchor", "uid", F.explode("sketch").alias("value"))
            often = values.groupBy("anchor", "value").count()
            typical = values.join(often, ["anchor", "value"]).groupBy("anchor", "uid").agg(F.sum("count").alias("score"))
            hubs = typical.groupBy("anchor").agg(F.max(F.struct("score", "uid")).getField("uid").alias("hub"))
            hubs = materialize(group.select(F.col("uid").alias("hub"), "anchor", "n", *BITS).join(hubs, ["anchor", "hub"]), "hubs")
            pairs = group.alias("x").join(hubs.alias("y"), (F.col("x.anchor") == F.col("y.anchor")) & (F.col("x.uid") != F.col("y.hub")) & F.expr(differing("x", "y", str(AROUND))))
            near = self.exact(self.estimated(pairs.select(F.col("x.uid").alias("a"), F.col("y.hub").alias("b")), str(AROUND), 0.0))
            near = near.where(f"common >= {AROUND} * united").withColumn("member", F.expr(f"100 * common >= {self.percent} * united")).withColumnsRenamed({"a": "uid", "b": "hub"})
            found = near if found is None else found.unionByName(near)
            done = near.where("member").select("uid").union(near.where("member").select("hub"))
            left = materialize(left.join(done.distinct(), "uid", "left_anti"), "left")
        if found is None:
            return None
        # A text is a member of one hub, and a hub with members is a member of none: stars, not chains.
        hubs = found.where("member").select(F.col("hub").alias("uid")).distinct()
        chained = found.join(hubs.withColumn("is_hub", F.lit(True)), "uid", "left")
        return materialize(chained.withColumn("member", F.expr("member and is_hub is null")).drop("is_hub"), "groups")

    def prefixes(self, units: DataFrame, t_of, fields: str, whole: bool = False, k: int | None = None) -> DataFrame:
        """value and `fields` of units, a row for each of the rarest retained values that two similar texts must share one of (or for each, if `whole`)."""
        names = [f.split()[0] for f in fields.split(", ")]
        freq = None if whole else self.frequencies() if k is None else self.counted(units)
        k = k or self.k

        def run(batches):
            order = None if freq is None else freq.value
            for batch in batches:
                at, values = [], []
                rows = batch.select([c for c in names if c in ("n", "r")]).to_pylist()
                for i, (s, row) in enumerate(zip(batch.column("sketch"), rows)):
                    s = s.values.to_numpy()
                    if not whole:
                        m = needed(row["n"], t_of(row), k)
                        s = s[np.lexsort((s, order[s.view(np.uint64) >> np.uint64(46)]))[: len(s) - m + 1]]
                    at.append(np.full(len(s), i))
                    values.append(s)
                if at:
                    part = batch.select(names).take(pa.array(np.concatenate(at)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(values), pa.int64()), *part.columns], ["value", *names])

        return units.select(*names, "sketch").mapInArrow(run, f"value long, {fields}")

    def frequencies(self):
        """How often values of each bucket are retained, as a broadcast vector of FREQ counts: the order of the inverted lists, rare first."""
        if not hasattr(self, "_freq"):
            self._freq = self.counted(self.units)
        return self._freq

    def counted(self, units: DataFrame):
        def count(batches):
            total = np.zeros(FREQ, np.int64)
            for batch in batches:
                v = batch.column(0).flatten().to_numpy().view(np.uint64) >> np.uint64(46)
                total += np.bincount(v.astype(np.int64), minlength=FREQ)
            there = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])

        got = units.select("sketch").coalesce(max(16, self.spark.sparkContext.defaultParallelism)).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
        out = np.zeros(FREQ, np.int64)
        out[got["bucket"].to_numpy()] = got["n"].to_numpy()
        return self.spark.sparkContext.broadcast(out)

    def met(self, x: DataFrame, y: DataFrame, key: list[str]) -> DataFrame:
        """a, b: units of the same inverted list that may be similar."""
        same = " and ".join(f"x.{c} = y.{c}" for c in key)
        pairs = x.alias("x").join(y.alias("y"), F.expr(f"{same} and x.uid < y.uid and {differing('x', 'y', str(self.t))} and not arrays_overlap(x.g, y.g)"))
        return pairs.select(F.col("x.uid").alias("a"), F.col("y.uid").alias("b"))

    def candidates(self, units: DataFrame) -> DataFrame:
        """a, b: units that share a prefix value.

        Two similar texts share one of the rarest values of their sketches.  Where very many share it, as texts with the same passage do
        that are not similar, a sketch is too small to tell them apart: they are compared by sketches of WIDE values, of
        which the passage's are no longer among the rarest.  Lists that are long even then are cut into parts, each pair of which meets in a task of its own.
        """
        fields, t = f"uid long, n long, {BIT_FIELDS}, g array<long>", self.t
        lists = self.prefixes(units, lambda row: t, fields)
        often = materialize(lists.groupBy("value").count().where(F.col("count") > OFTEN).select("value"), "often")
        if not (n := often.count()):
            return self.met(lists, lists, ["value"]).distinct()
        often = F.broadcast(often) if n <= FEW else often
        hot = materialize(lists.join(often, "value", "left_semi").select("uid").distinct(), "hot")
        lists = lists.join(often, "value", "left_anti")
        larger = self.sets(hot).select("uid", F.slice("set", 1, WIDE).alias("sketch"))
        wide = materialize(units.select(*(f.split()[0] for f in fields.split(", "))).join(larger, "uid"), "wide")
        found = self.met(lists, lists, ["value"])
        again = materialize(self.prefixes(wide, lambda row: t, fields, k=WIDE), "wide-lists")
        parts = again.groupBy("value").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")).where("parts > 1")
        parts = materialize(parts, "parts")
        if parts.isEmpty():
            return found.union(self.met(again, again, ["value"])).distinct()
        again = again.join(F.broadcast(parts) if parts.count() <= FEW else parts, "value", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        x = again.withColumn("part", F.pmod(F.xxhash64("uid"), "parts").cast("int"))
        y = again.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        return found.union(self.met(x, y, ["value", "part"])).distinct()

    def linked(self, found: DataFrame) -> DataFrame:
        return found.where(f"100 * common >= {self.percent} * united").select("a", "b")

    def links(self) -> DataFrame:
        """a, b: pairs of units that are similar, enough of them to connect all that similar pairs connect."""
        t = self.t
        with interpreted(self.spark):
            groups = self.groups()
        units = self.units.withColumn("g", F.array().cast("array<long>"))
        if groups is not None:
            own = groups.groupBy("uid").agg(F.array_sort(F.collect_set("hub")).alias("g"), F.max("member").alias("member"))
            units = self.units.join(own, "uid", "left").where("member is null or not member").withColumn("g", F.coalesce("g", F.array().cast("array<long>")))
            hubs = groups.where("member").select(F.col("hub").alias("uid")).distinct().withColumn("hub", F.lit(True))
            units = units.join(hubs, "uid", "left").where("hub is null").drop("hub", "member")
            units = materialize(units, "single")
        pairs = self.candidates(units)
        near = self.linked(self.exact(self.estimated(pairs, str(t))))
        if groups is None:
            return near
        with interpreted(self.spark):
            stars = groups.where("member")
            return near.union(stars.select(F.col("uid").alias("a"), F.col("hub").alias("b"))).union(self.inside(groups)).union(self.around(units, stars))

    def classes(self) -> DataFrame:
        """sig, root of the sets that are linked with others: equal roots, one component."""
        return components(self.links()).join(self.units.select(F.col("uid").alias("node"), "sig"), "node").select("sig", "root")

    def inside(self, groups: DataFrame) -> DataFrame:
        """a, b: links of texts that are not their hub's members with others of the same hub, enough to connect them."""
        edge = groups.where("not member").select(F.col("hub").alias("a"), "uid")
        return self.compared(edge, groups.select(F.col("hub").alias("a"), "uid").join(edge.select("a").distinct(), "a", "left_semi"))

    def compared(self, probes: DataFrame, targets: DataFrame) -> DataFrame:
        """a, b: links between probes (a, uid) and targets (a, uid) of the same a: those of a spanning forest of each pair of blocks.

        Both sides are cut into blocks of about BLOCK values, and each pair of blocks is compared inside a task by its inverted lists: of any
        number of links no more rows come out than there are texts in the two blocks.
        """
        percent = self.percent
        sets = materialize(self.sets(probes.select("uid").union(targets.select("uid"))), "sets")

        def parts(side: DataFrame) -> DataFrame:
            return side.join(self.units.select("uid", "n"), "uid").groupBy("a").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("parts"))

        many = materialize(parts(probes).withColumnRenamed("parts", "pp").join(parts(targets).withColumnRenamed("parts", "qq"), "a"), "parts")

        def blocks(side: DataFrame, own: str, other: str, name: str) -> DataFrame:
            placed = side.join(many, "a").withColumn(own, F.pmod(F.hash("uid"), own)).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            keyed = placed.join(sets, "uid").select("a", F.col(own).alias(f"k{own}"), F.col("copy").alias(f"k{other}"), F.struct("uid", "set").alias("text"))
            return keyed.groupBy("a", "kpp", "kqq").agg(F.collect_list("text").alias(name))

        pairs = blocks(probes, "pp", "qq", "p").join(blocks(targets, "qq", "pp", "q"), ["a", "kpp", "kqq"])

        def run(batches):
            for batch in batches:
                a, b = [], []
                for p, q in zip(batch.column("p"), batch.column("q")):
                    p_uid, q_uid = (x.values.field("uid").to_numpy() for x in (p, q))
                    p_sets, q_sets = ([y.values.to_numpy() for y in x.values.field("set")] for x in (p, q))
                    size = np.array(list(map(len, q_sets)))
                    value = np.concatenate(q_sets)
                    order = np.argsort(value, kind="stable")
                    value, owner = value[order], np.repeat(np.arange(len(q_sets)), size)[order]
                    root = {}

                    def find(u, root=root):
                        while (up := root.get(u, u)) != u:
                            root[u] = root.get(up, up)
                            u = up
                        return u

                    for uid, s in zip(p_uid.tolist(), p_sets):
                        low, high = np.searchsorted(value, s), np.searchsorted(value, s, side="right")
                        many = high - low
                        at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
                        common = np.bincount(owner[at], minlength=len(q_sets))
                        for other in q_uid[np.flatnonzero(100 * common >= percent * (size + len(s) - common))].tolist():
                            if (x := find(uid)) != (y := find(other)):
                                root[x] = y
                                a.append(uid)
                                b.append(other)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        return materialize(pairs.select("p", "q").mapInArrow(run, "a long, b long"), "compared")

    def around(self, single: DataFrame, stars: DataFrame) -> DataFrame:
        """a, b: links between stars, and between stars and texts of other groups.

        1 - similarity is a metric.  So a text linked with a member of a star is at most 1 - t plus the star's radius
        from its hub: only texts that near are compared with its members, block by block.
        """
        t, percent = self.t, self.percent
        radius = stars.groupBy(F.col("hub").alias("uid")).agg(F.max(1 - F.col("common") / F.col("united")).alias("r"))
        hubs = self.units.join(F.broadcast(radius) if stars.count() <= FEW else radius, "uid").withColumn("g", F.array("uid"))
        hubs = materialize(hubs, "hubs")
        every = single.withColumn("r", F.lit(0.0)).unionByName(hubs)
        most = 1 - t
        fields = f"uid long, n long, {BIT_FIELDS}, r double, g array<long>"
        probe = materialize(self.prefixes(hubs, lambda row: max(0.01, t - row["r"] - most), fields), "probe")
        lists = self.prefixes(every, None, fields, whole=True)
        reach = f"greatest(0.01, {t} - x.r - y.r)"
        few = probe.count() <= FEW // 10
        pairs = lists.alias("y").join((F.broadcast(probe) if few else probe).alias("x"), F.expr("x.value = y.value and x.uid <> y.uid and (y.r = 0 or x.uid < y.uid) and not array_contains(y.g, x.uid) and " + differing("x", "y", reach)))
        pairs = pairs.select(F.col("x.uid").alias("a"), F.col("y.uid").alias("b"), (F.col("x.r") + F.col("y.r")).alias("r")).distinct()
        found = self.exact(self.estimated(pairs, f"greatest(0.01, {t} - r)"))
        direct = self.linked(found)
        open_ = materialize(found.where(f"100 * common < {percent} * united and common >= ({t} - r - 1e-9) * united").select("a", "b"), "open")
        if open_.isEmpty():
            return direct
        member = stars.select("hub", "uid").union(hubs.select("uid", "uid"))
        probes = open_.join(member.withColumnsRenamed({"hub": "b", "uid": "m"}), "b", "left").select("a", F.coalesce("m", "b").alias("uid")).distinct()
        targets = open_.select("a").distinct().join(member.withColumnRenamed("hub", "a"), "a")
        return direct.union(self.compared(probes, targets))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, k: int = K, hot: int = HOT) -> DataFrame:
    """doc_id, th, n_shingles, component_id, kept of every row of docs (doc_id, text).

    Links texts whose sets of `words`-word shingles have 100 * intersection >= percent * union; a text of fewer words
    has its whole sequence as one shingle.  component_id is the smallest doc_id that links reach (nulls aside), kept
    says whether it is the row's own.  Texts that are null or without words have empty sets, are linked with nothing and kept.
    Rows that repeat are in one component; a row whose doc_id is null is in the component of its text and is kept only if no
    doc_id is known there.  An empty table gives an empty result; other columns are ignored.

    Sketch overlap and bits decide candidates at five standard deviations; every link is confirmed on the full sets.
    """
    search = Search(docs, words, percent, k, hot)
    nodes = search.classes()
    ids = search.rows.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least"))
    linked = materialize(ids.join(nodes, "sig", "left"), "linked")
    roots = linked.where("root is not null").groupBy("root").agg(F.min("least").alias("component_id"))
    found = linked.join(roots, "root", "left").select("sig", F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    out = search.rows.select("doc_id", "th", "n", "sig").join(found, "sig", "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), own.alias("component_id"), "sig").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80, k: int = K, hot: int = HOT) -> DataFrame:
    """docs (its columns and rows as they are) without near-duplicates: exactly one row of each component.

    It is the row of the smallest doc_id; rows without doc_id come last, ties go by hashes of text and row, and of rows that are equal
    in all columns one stays.  Texts that are null or without words are no duplicates of anything and all stay.  An empty table stays
    empty; other columns are kept, and names that clash do no harm.
    """
    search = Search(docs, words, percent, k, hot, rows=True)
    full = search.rows.where("n > 0").groupBy("sig", "doc_id", "th", "rh").agg(F.count("*").alias("copies")).join(search.classes(), "sig", "left")
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "th", "rh", "copies")).alias("first")
    best = full.groupBy("root", F.when(F.col("root").isNull(), F.col("sig")).alias("alone")).agg(first).select("first.th", "first.rh", (F.col("first.copies") > 1).alias("again"))
    blank = search.rows.where("n = 0").select("th", "rh").distinct().withColumn("again", F.lit(False))
    th, rh = fresh(docs, "th_"), fresh(docs, "rh_")
    stay = materialize(best.unionByName(blank).select(F.col("th").alias(th), F.col("rh").alias(rh), "again"), "kept")
    keyed = docs.withColumns({th: F.xxhash64("text"), rh: F.xxhash64(*hashable(docs))})
    # The side without texts is the one that is built in memory; rows with a th and rh are equal.
    pick = lambda r: keyed.join(r.select(th, rh).hint("shuffle_hash"), [th, rh])
    out, twice = pick(stay.where("not again")), stay.where("again")
    if not twice.isEmpty():
        out = out.unionByName(pick(twice).dropDuplicates([th, rh]))
    return out.select(docs.columns)
