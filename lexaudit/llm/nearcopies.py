"""Near copies of articles (problem 7).

Each article becomes the set of its word shingles, hashed by one function; the K least hashes are its sketch. Inverted
lists of the retained values generate the pairs that overlap, the overlap a pair's sketches must have at the wanted
similarity filters them, and exact Jaccard on the full sets verifies the rest.

Stock phrases stand in very many sketches. Values are therefore taken in one order for all, roughly the rarest first, and
each list row carries what follows its value in that order: a list too long to compare is divided by a second shared value,
then a third, until what is left is short. Two sketches with the overlap a similar pair must have always meet, because the
chain of the values they share, in order, is one of the divisions. No list and no number of partners is capped.
Equal sets are one class from the start, so that a text copied any number of times makes one list entry.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil, exp, lgamma

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexaudit.session import materialize

#: Values of a sketch, and the chance by which a pair just at the threshold may fall short of the overlap asked for.
K, LOSS = 48, 1e-5
#: Buckets of values, by whose counts values are ordered; rows of lists worked on together; the longest list compared
#: whole; the longest list held by a task, beyond which its divisions are sent on as lists of their own.
BUCKETS, HELD, WHOLE, LONG = 1 << 18, 200_000, 64, 400_000
#: Words of 64 bits of the parity maps by which overlaps are bounded; pairs whose overlaps are counted together.
PARITY, CHECKED = 4, 4096
#: Sizes of sets for which quantiles are kept; a set counts as the next greater.
SIZES = [64, 96, 144, 216, 324, 486, 729, 1_000_000_000]

_WORD = re.compile(r"[^\W_]+")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; the one hash function is this over the words' hashes."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Shingle sets as sorted arrays of 64-bit hashes; words' hashes are remembered up to a bound."""

    MEMO = 300_000

    def __init__(self, words: int) -> None:
        import xxhash

        self.words, self._hash, self._memo = words, xxhash.xxh64_intdigest, {}

    def sets(self, title: str | None, content: str | None, least_words: int) -> np.ndarray | None:
        body = _WORD.findall((content or "").lower())
        if len(body) < least_words:
            return None
        w = _WORD.findall((title or "").lower()) + body
        memo, codes = self._memo, []
        for x in w:
            h = memo.get(x)
            if h is None:
                if len(memo) >= self.MEMO:
                    memo.clear()
                h = memo[x] = self._hash(x)
            codes.append(h)
        c = np.array(codes, dtype=np.uint64)
        n = len(c) - self.words + 1
        if n < 1:
            return np.empty(0, dtype=np.int64)
        with np.errstate(over="ignore"):
            h = c[:n].copy()
            for k in range(1, self.words):
                h = (h * _M1) ^ (c[k : k + n] * _M2 + np.uint64(k))
                h ^= h >> np.uint64(31)
            return np.unique(_mix(h).view(np.int64))


def signatures(articles: DataFrame, words: int = 3, least_words: int = 60, k: int | None = K) -> DataFrame:
    """id, sig (equal for equal sets), n (size of the set), sketch (its k least hashes; all for None) of each article that counts.

    Left out are rows with NULL id and those whose content has fewer than least_words words, NULL and empty included.
    """

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = Shingler(words)
        for b in batches:
            out = []
            for i, title, content in zip(b["article_id"], b["title"], b["content"]):
                x = s.sets(title, content, least_words)
                if x is not None and len(x):
                    out.append((i, s._hash(x.tobytes()) - (1 << 63), len(x), x[:k]))
            yield pd.DataFrame(out, columns=["id", "sig", "n", "sketch"])

    rows = articles.select("article_id", "title", "content").where("article_id IS NOT NULL")
    return rows.mapInPandas(make, "id bigint, sig bigint, n int, sketch array<bigint>")


def full_sets(articles: DataFrame, words: int = 3, least_words: int = 60) -> DataFrame:
    """id and the whole shingle set of articles."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = Shingler(words)
        for b in batches:
            out = []
            for i, title, content in zip(b["article_id"], b["title"], b["content"]):
                x = s.sets(title, content, least_words)
                if x is not None:
                    out.append((i, x))
            yield pd.DataFrame(out, columns=["id", "shingles"])

    return articles.select("article_id", "title", "content").mapInPandas(make, "id bigint, shingles array<bigint>")


def least_overlaps(k: int, threshold: float, n: int) -> np.ndarray:
    """How many values the sketches of a similar pair share at least, by the ratio of their sizes in hundredths, n the greater.

    Of sets of sizes m <= n with the threshold's similarity, at least t (1 + m/n) / (1 + t) of the greater lies in the other.
    The values of the greater's sketch that do are hypergeometric, those of the lesser's more, and the sketches share the
    lesser of both counts. The figure is the quantile that all but LOSS of such pairs reach.
    """
    out = np.zeros(101, dtype=np.int64)
    for r in range(101):
        inside = ceil(n * threshold * (1 + max(r / 100, threshold)) / (1 + threshold) - 1e-6)
        log_c = lambda a, b: lgamma(a + 1) - lgamma(b + 1) - lgamma(a - b + 1) if 0 <= b <= a else float("-inf")
        total = 0.0
        for x in range(k + 1):
            total += exp(log_c(inside, x) + log_c(n - inside, k - x) - log_c(n, k))
            if 2 * total > LOSS:
                out[r] = max(1, x)
                break
    return out


class Overlap:
    """The overlap that pairs of sketches must have for a threshold; exact where whole sets are the sketches (k None)."""

    def __init__(self, k: int | None, threshold: float) -> None:
        self.t, self.k = threshold, k
        self.sizes = np.array([n for n in SIZES if k and n >= 1.5 * k])
        self.table = np.array([least_overlaps(k, threshold, int(n)) for n in self.sizes]) if k else None

        self.most = int(self.table.max()) if k else 1 << 40

    def ratio(self, reached: int) -> float:
        """The greatest ratio of sizes at which a pair may be asked for no more than so many values; 0 for none."""
        if self.table is None:
            return 0.0
        r = np.flatnonzero(self.table.min(axis=0) <= reached)
        return min(1.0, (r[-1] + 1) / 100) if len(r) else 0.0

    def alone(self, n: np.ndarray) -> np.ndarray:
        """Of sets of sizes n, with any partner."""
        whole = np.ceil(self.t * n - 1e-9).astype(np.int64)
        return whole if self.table is None else np.minimum(whole, self.table.min(axis=0)[0])

    def of(self, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Of pairs of sets of sizes n and m; more than a sketch holds where the sizes forbid similarity."""
        small, great = np.minimum(n, m), np.maximum(n, m)
        asked = np.ceil(self.t / (1 + self.t) * (small + great) - 1e-9).astype(np.int64)
        if self.table is not None:
            part = self.table[np.searchsorted(self.sizes, great), small * 100 // great]
            asked = np.where(great <= self.k, asked, np.minimum(part, np.ceil(self.t * great - 1e-9).astype(np.int64)))
        return np.where(small < self.t * great - 1e-9, 1 << 40, asked)


def _scrambled(key: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Keys of the divisions of lists `key` by values."""
    with np.errstate(over="ignore"):
        return _mix(key.view(np.uint64) * _M1 ^ value.astype(np.uint64) * _M2).view(np.int64)


class Lists:
    """Rows of inverted lists: the list's key, id, size of the set, and the values that follow in the order of all, as 16 bits each.

    Equal values are equal in 16 bits too, so that what is counted on them is never too little.
    """

    def __init__(self, parts: list[pd.DataFrame], overlap: Overlap) -> None:
        x = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        self.overlap = overlap
        self.key, self.id, self.n, self.level = (x[c].to_numpy(dtype=np.int64) for c in ("key", "id", "n", "level"))
        self.flat = np.frombuffer(b"".join(x["rest"]), dtype=np.uint16)
        self.end = np.cumsum(x["rest"].str.len().to_numpy(dtype=np.int64) // 2)
        self.start = np.concatenate(([0], self.end[:-1]))
        self.least = overlap.alone(self.n)

    def parities(self) -> list[np.ndarray]:
        """Parity maps of the values from each place of `flat` on; two differ in at most as many bits as sets in values."""
        bit = (self.flat.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(16)
        bit = bit % np.uint32(64 * PARITY)
        one, out = np.uint64(1) << (bit & np.uint32(63)).astype(np.uint64), []
        for w in range(PARITY):
            own = np.zeros(len(bit) + 1, dtype=np.uint64)
            own[:-1] = np.where(bit >> np.uint32(6) == w, one, np.uint64(0))
            out.append(np.bitwise_xor.accumulate(own[::-1])[::-1])
        return out

    def divided(self, row: np.ndarray, at: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the parent, place) of each further value by which rows can be divided and still reach the least overlap."""
        stop = self.end[row] - np.maximum(self.least[row] - level - 1, 0)
        many = np.maximum(stop - at, 0)
        parent = np.repeat(np.arange(len(row)), many)
        return parent, at[parent] + np.arange(len(parent)) - np.repeat(np.cumsum(many) - many, many)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs of ids, in lists of any length, whose sketches may share enough."""
        acc = self.parities()
        label = np.concatenate(([0], np.cumsum(self.key[1:] != self.key[:-1])))
        row, at, level = np.arange(len(self.key)), self.start, self.level
        while len(row):
            order = np.argsort(label, kind="stable")
            label, row, at, level = label[order], row[order], at[order], level[order]
            new = np.concatenate(([True], label[1:] != label[:-1]))
            label, first = np.cumsum(new), np.flatnonzero(new)
            size = np.diff(np.concatenate((first, [len(label)])))
            whole = (size <= WHOLE) | (level[first] >= self.overlap.most)
            maps = [x[at] ^ x[self.end[row]] for x in acc], (self.end[row] - at + level).astype(np.int16), self.least[row].astype(np.int16)
            near = np.flatnonzero(np.repeat(whole & (size > 1) & (size <= WHOLE), size))
            yield from self._near(near, label, row, at, level, maps)
            # a pair that need not share more than has been used to divide is found here, not in a division
            due = (size > WHOLE) & (level[first] >= np.minimum.reduceat(self.least[row], first))
            for f, s in zip(first[due], size[due]):
                yield from self._due(np.arange(f, f + s), row, at, level, maps)
            go = np.repeat(~whole, size)
            parent, place = self.divided(row[go], at[go], level[go])
            label, row, at, level = label[go][parent] << 16 | self.flat[place], row[go][parent], place + 1, level[go][parent] + 1

    def _enough(self, p, q, row, at, level, maps) -> np.ndarray:
        words, room, least = maps
        apart = np.bitwise_count(words[0][p] ^ words[0][q]).astype(np.int16)
        for w in words[1:]:
            apart += np.bitwise_count(w[p] ^ w[q])
        ok = room[p] + room[q] - apart >= 2 * np.maximum(least[p], least[q])
        k = np.flatnonzero(ok)
        i, j = row[p[k]], row[q[k]]
        asked = self.overlap.of(self.n[i], self.n[j])
        ok[k] = (room[p[k]] + room[q[k]] - apart[k] >= 2 * asked) & (self.id[i] != self.id[j])
        asked, k = asked[ok[k]], k[ok[k]]
        for c in range(0, len(k), CHECKED):
            few, a, b = slice(c, c + CHECKED), p[k[c : c + CHECKED]], q[k[c : c + CHECKED]]
            ok[k[few]] = self._shared(row[a], at[a], row[b], at[b]) + level[a] >= asked[few]
        return ok

    def _shared(self, i, at_i, j, at_j) -> np.ndarray:
        """How many values behind the given places rows share."""

        def square(row, at, none):
            width = np.arange(int((self.end[row] - at).max(initial=0)))
            place = at[:, None] + width
            return np.where(place < self.end[row][:, None], self.flat[np.minimum(place, max(0, len(self.flat) - 1))].astype(np.int32) if len(self.flat) else none, none)

        x, y = square(i, at_i, -1), square(j, at_j, -2)
        return (x[:, :, None] == y[:, None, :]).any(axis=2).sum(axis=1)

    def _near(self, at_rows, label, row, at, level, maps):
        k = 0
        while len(at_rows):
            k += 1
            at_rows = at_rows[at_rows + k < len(label)]
            at_rows = at_rows[label[at_rows + k] == label[at_rows]]
            ok = self._enough(at_rows, at_rows + k, row, at, level, maps)
            p, q = self.id[row[at_rows[ok]]], self.id[row[at_rows[ok] + k]]
            yield np.minimum(p, q), np.maximum(p, q)

    def _due(self, span, row, at, level, maps):
        """The pairs of one long list that need not share more values than its level."""
        span = span[np.argsort(self.n[row[span]], kind="stable")]
        n, reached = self.n[row[span]], int(level[span[0]])
        after = np.arange(1, len(n) + 1)
        # small sets, and sets of sizes so different that few shared values are asked of them
        small = np.where(n * self.overlap.t <= reached, np.searchsorted(n, reached / self.overlap.t, side="right"), after)
        ratio = self.overlap.ratio(reached)
        lo = np.maximum(np.searchsorted(n, n / ratio - 1e-9) if ratio else len(n), np.maximum(after, small))
        hi = np.maximum(lo, np.searchsorted(n, n / self.overlap.t + 1e-9, side="right"))
        for begin, end in ((after, np.maximum(after, small)), (lo, hi)):
            many = np.cumsum(end - begin)
            f = 0
            while f < len(n):
                g = max(f + 1, int(np.searchsorted(many, (many[f - 1] if f else 0) + HELD)))
                c = (end - begin)[f:g]
                p = np.repeat(np.arange(f, g), c)
                q = begin[p] + np.arange(len(p)) - np.repeat(np.cumsum(c) - c, c)
                ok = self._enough(span[p], span[q], row, at, level, maps)
                a, b = self.id[row[span[p[ok]]]], self.id[row[span[q[ok]]]]
                yield np.minimum(a, b), np.maximum(a, b)
                f = g

    def send_on(self) -> pd.DataFrame:
        """The divisions of these rows, as rows of further lists."""
        parent, place = self.divided(np.arange(len(self.key)), self.start, self.level)
        rest = [self.flat[a:b].tobytes() for a, b in zip(place + 1, self.end[parent])]
        return pd.DataFrame({"key": _scrambled(self.key[parent], self.flat[place]), "id": self.id[parent], "other": np.int64(0), "n": self.n[parent], "level": self.level[parent] + 1, "rest": rest})


LIST_ROWS = "key bigint, id bigint, n int, level int, rest binary"


def list_rows(made: DataFrame, counts, overlap: Overlap) -> DataFrame:
    """The list rows of sketches(id, n, sketch): one for each value that can be the first of the least overlap."""

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            size = b["sketch"].str.len().to_numpy(dtype=np.int64)
            v, doc = np.concatenate(b["sketch"].to_numpy()), np.repeat(np.arange(len(b)), size)
            v = v[np.lexsort((v, counts.value[v & (BUCKETS - 1)], doc))]
            short = (_mix(v.view(np.uint64)) >> np.uint64(48)).astype(np.uint16).tobytes()
            end = np.cumsum(size)
            place = np.arange(len(v)) - (end - size)[doc]
            n = b["n"].to_numpy(dtype=np.int64)
            at = np.flatnonzero(place <= (size - overlap.alone(n))[doc])
            rest = [short[x:y] for x, y in zip((2 * at + 2).tolist(), (2 * end[doc[at]]).tolist())]
            yield pd.DataFrame({"key": v[at], "id": b["id"].to_numpy()[doc[at]], "n": n[doc[at]], "level": 1, "rest": rest})

    return made.select("id", "n", "sketch").mapInPandas(post, LIST_ROWS)


def candidates(made: DataFrame, threshold: float, k: int | None = K, long: int = LONG) -> DataFrame:
    """Pairs a, b (ids, a < b) of sketches(id, n, sketch) that may reach the threshold.

    With k None (whole sets as sketches) no pair that does is missed; else one just at the threshold is with a chance of LOSS
    at most, and the more similar ones with far less.
    """
    spark, overlap = made.sparkSession, Overlap(k, threshold)
    bucket = F.col("v").bitwiseAND(BUCKETS - 1)
    got = made.select(F.explode("sketch").alias("v")).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).toPandas()  # at most BUCKETS rows
    array = np.zeros(BUCKETS, dtype=np.int64)
    array[got["bucket"]] = got["n"]
    counts = spark.sparkContext.broadcast(array)

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, sent = [], 0, None  # whole lists and the last one, which may go on; the key of a list that is sent on
        for b in batches:
            key = b["key"].to_numpy()
            if sent is not None:
                cut = int(np.searchsorted(key, sent, side="right"))
                if cut:
                    yield Lists([b.iloc[:cut]], overlap).send_on()
                    b, key = b.iloc[cut:], key[cut:]
                if not len(key):
                    continue
                sent = None
            if not len(key):
                continue
            if size + len(b) > HELD and held:
                yield from met(held, key[0])
                last = held[-1]["key"].to_numpy()[-1]
                held = [x for x in (x[x["key"].to_numpy() == last] for x in held) if len(x)] if last == key[0] else []
                size = sum(map(len, held))
            held.append(b)
            size += len(b)
            last = key[-1]
            level = int(b["level"].iloc[-1])
            of_last = sum(int((x["key"].to_numpy() == last).sum()) for x in held) if size > long else 0
            if of_last > long and level < int(overlap.alone(np.concatenate([x["n"].to_numpy()[x["key"].to_numpy() == last] for x in held])).min()):
                yield from met(held, last)
                yield Lists([x[x["key"].to_numpy() == last] for x in held], overlap).send_on()
                held, size, sent = [], 0, last
        if held:
            yield from met(held, None)

    def met(parts: list[pd.DataFrame], but) -> Iterator[pd.DataFrame]:
        """The pairs of the lists of some rows, but for one list."""
        if but is not None:
            parts = [x for x in (x[x["key"].to_numpy() != but] for x in parts) if len(x)]
        if not parts:
            return
        some, size = [], 0
        for p in Lists(parts, overlap).pairs():
            if len(p[0]):
                some.append(p)
                size += len(p[0])
            if size >= HELD:
                yield found(some)
                some, size = [], 0
        if size:
            yield found(some)

    def found(some: list) -> pd.DataFrame:
        a, b = map(np.concatenate, zip(*some))
        x = pd.DataFrame({"id": a, "other": b}).drop_duplicates()
        return x.assign(key=0, n=0, level=0, rest=None)[["key", "id", "other", "n", "level", "rest"]]

    rows, out = list_rows(made, counts, overlap), None
    while True:
        got = rows.repartition("key").sortWithinPartitions("key").mapInPandas(meet, "key bigint, id bigint, other bigint, n int, level int, rest binary")
        got = materialize(got, "lists")
        part = got.where("rest IS NULL").select(F.col("id").alias("a"), F.col("other").alias("b"))
        out = part if out is None else out.unionByName(part)
        rows = got.where("rest IS NOT NULL").drop("other")
        if rows.isEmpty():
            return out.distinct()


def similar_classes(articles: DataFrame, threshold: float = 0.5, words: int = 3, least_words: int = 60, k: int | None = K) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): members id, rep (the least id of equal sets); pairs a, b, jaccard of representatives with a
    similarity of at least the threshold, a < b."""
    made = materialize(signatures(articles, words, least_words, k), "signatures")
    least = made.groupBy("sig", "n").agg(F.min("id").alias("rep"))
    members = materialize(made.select("id", "sig", "n").join(least, ["sig", "n"]).select("id", "rep"), "members")
    copies = members.where("id <> rep").select("id")
    found = materialize(candidates(made.join(copies, "id", "left_anti"), threshold, k), "candidates")
    # written, so that its size is known before the texts are joined with it
    wanted = materialize(found.select(F.explode(F.array("a", "b")).alias("article_id")).distinct(), "wanted")
    sets = full_sets(articles.join(wanted, "article_id", "left_semi"), words, least_words)
    one, two = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    pairs = found.join(one, "a").join(two, "b").select("a", "b", (common / (F.size("x") + F.size("y") - common)).alias("jaccard"))
    return members, pairs.where(F.col("jaccard") >= threshold)


def similar_pairs(articles: DataFrame, threshold: float = 0.5, words: int = 3, least_words: int = 60, k: int | None = K) -> DataFrame:
    """Every pair article_a < article_b with a similarity of at least the threshold, copies expanded; see candidates() for k.

    Ids must be unique; of rows with equal ids one counts.
    """
    members, pairs = similar_classes(articles, threshold, words, least_words, k)
    pairs = materialize(pairs, "pairs")
    m, o = members.select(F.col("rep").alias("a"), F.col("id").alias("p")), members.select(F.col("rep").alias("b"), F.col("id").alias("q"))
    across = pairs.select("a", "b").join(m, "a").join(o, "b").select("p", "q")
    within = m.join(o.withColumnRenamed("b", "a"), "a").where("p < q").select("p", "q")
    return across.unionByName(within).select(F.least("p", "q").alias("article_a"), F.greatest("p", "q").alias("article_b")).where("article_a < article_b").distinct()


def similar_groups(articles: DataFrame, threshold: float = 0.5, words: int = 3, least_words: int = 60, k: int | None = K) -> DataFrame:
    """article_id, class_id (the least id of its group), links (of its text to different texts), for every article in a
    group of two or more.

    Groups are the connected components of equal and similar texts: each round, a text takes the least label of its
    neighbours and then the label of its label, until nothing changes. Rounds are written to the shared folder.
    """
    members, pairs = similar_classes(articles, threshold, words, least_words, k)
    pairs = materialize(pairs.select("a", "b"), "pairs")
    edges = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"), F.count("*").alias("links"))
    labels = materialize(labels.select(F.col("a").alias("id"), "label", "links"), "labels")
    while True:
        near = edges.join(labels.select(F.col("id").alias("b"), F.col("label").alias("l")), "b").groupBy("a").agg(F.min("l").alias("l"))
        hop = labels.select(F.col("id").alias("label"), F.col("label").alias("ll"))
        new = labels.join(near, labels.id == near.a).join(hop, "label").select("id", F.least("label", "l", "ll").alias("label"), "links", F.col("label").alias("old"))
        new = materialize(new, "labels")
        if new.where("label <> old").isEmpty():
            break
        labels = new.drop("old")
    classed = members.join(labels.select(F.col("id").alias("rep"), "label", "links"), "rep", "left")
    classed = classed.select(F.col("id").alias("article_id"), F.coalesce("label", "rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))
    several = classed.groupBy("class_id").agg(F.count("*").alias("size")).where("size > 1").select("class_id")
    return classed.join(several, "class_id", "left_semi").select("article_id", "class_id", "links")
