"""Problem 3: records that share most of their content, found by Golay-code fuzzy hashing."""

from __future__ import annotations

from functools import lru_cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.operators.pairs import meetings, sharing
from lodestrata.session import settle

#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the binary Golay code (23, 12, 7). Fixed value.
GENERATOR = 0b110001110101
BITS = 23
#: ASCII letters and digits as they are in lower case, all else a blank.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))
#: The share of the pairs at the threshold itself that the bands may miss.
MISSED = 3e-4
#: Random texts that a text may meet in mean, all bands together, before one more guard is taken.
RANDOM_MET = 64
#: So many deviations below what a pair at the threshold has in mean, sketches still agree enough: one such pair in 12,000 is lost.
DEVIATIONS = 4
#: Texts of one key that are compared where they arrive; more go on in blocks of as many.
MEETING = 1024
#: Rows of one guard that a task holds at most.
CROWD = 200_000
#: Minimum hashes by which candidates are compared, and the columns that hold four bits of each.
HASHES, SKETCH = 96, ["one", "two", "three", "four", "five", "six"]


def _syndrome(words: np.ndarray) -> np.ndarray:
    """The remainder of each 23-bit polynomial modulo the generator."""
    rest = words.astype(np.int64)
    for bit in range(BITS - 1, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome, the error pattern of up to three bits; by byte and place, the syndrome of that byte."""
    one = [1 << i for i in range(BITS)]
    errors = [0, *one]
    errors += [a | b for i, a in enumerate(one) for b in one[:i]]
    errors += [a | b | c for i, a in enumerate(one) for j, b in enumerate(one[:i]) for c in one[:j]]
    leader = np.zeros(2048, np.int64)
    leader[_syndrome(np.array(errors))] = errors  # a perfect code: each syndrome has exactly one
    return leader, np.array([_syndrome(np.arange(256) << s) for s in (0, 8, 16)])


def decode(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword within three bits of each 23-bit word."""
    leader, by_byte = _tables()
    syndrome = by_byte[0][words & 255] ^ by_byte[1][words >> 8 & 255] ^ by_byte[2][words >> 16 & 255]
    return (words ^ leader[syndrome]) >> 11


def near_indices(words: np.ndarray) -> np.ndarray:
    """For each word a row of the codeword indices of it and its 23 neighbours, sorted: one value or six, repeated.

    Words up to two bits apart share an index, as some word lies within one bit of both.
    """
    around = words[:, None] ^ np.append(0, 1 << np.arange(BITS))[None, :]
    return np.sort(decode(around), axis=1)


def six_indices(words: np.ndarray) -> np.ndarray:
    """near_indices without repetition: six columns, all equal where a word has one index."""
    near = near_indices(words)
    first = np.ones(near.shape, bool)
    first[:, 1:] = near[:, 1:] != near[:, :-1]
    out = np.repeat(near[:, :1], 6, axis=1)
    row, at = np.nonzero(first)
    out[row, first.cumsum(axis=1)[row, at] - 1] = near[row, at]
    return out


def words_of(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters and digits of the lower-cased text."""
    return (text if text.isascii() else text.lower()).encode("utf-8", "replace").translate(PLAIN).split()


def shingles(text: str, width: int) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    return set(zip(*(words[i:] for i in range(width))))


def _mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of 64 (Stafford's variant 13)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(4)
def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = (_mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
    return seeds[:n] | np.uint32(1), seeds[n:]


def fingerprint(hashes: np.ndarray, n: int) -> np.ndarray:
    """``n`` minimum hashes of a set of hashes, by 32 of their bits, each brought to 16 well-mixed bits."""
    times, plus = _multipliers(n)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(n, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(short), 4096):
        out = np.minimum(out, (short[start : start + 4096, None] * times + plus).min(axis=0))
    return (_mix(out.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def sketch_of(mins: np.ndarray) -> np.ndarray:
    """Columns of 64 bits: the top four bits of the first 96 minimum hashes, which the segments leave out, 16 to a column."""
    top = (mins[:, :HASHES] >> 12).astype(np.uint64).reshape(len(mins), -1, 16)
    return (top << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=2, dtype=np.uint64).view(np.int64)


def segments_of(mins: np.ndarray, guards: int) -> tuple[np.ndarray, np.ndarray]:
    """The guards and the six codeword indices of each band of the fingerprints in the rows of ``mins``.

    A band has a guard of ``guards`` minimum hashes (12 bits each) that counts as it is, and a fuzzy 23-bit segment of two more (12
    and 11 bits) that is decoded to its nearby codeword indices. So two records share a key of the band, a guard with an index, if their
    guards agree and their fuzzy segments differ in at most two bits. By the pigeonhole principle some band does
    unless every band has an error in its guard or three in its fuzzy segment.
    """
    bands = mins.shape[1] // (guards + 2)
    low = mins.astype(np.int64).reshape(len(mins), bands, guards + 2) & 0xFFF
    index = six_indices((low[:, :, guards] << 11 | low[:, :, guards + 1] & 0x7FF).ravel())
    guard = np.broadcast_to(np.arange(bands), (len(mins), bands)).astype(np.int64)
    for k in range(guards):
        guard = guard << 12 | low[:, :, k]
    return guard.ravel(), index


class WordHashes(dict):
    """Well-mixed 64-bit hashes of words, kept for words seen often."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < 500_000:
            self[word] = value
        return value


def shingle_hashes(words: list[bytes], width: int, known: dict) -> np.ndarray:
    each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    out = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + each[i : i + len(out)])
    return np.unique(out)


def band_chance(similarity: float, guards: int) -> float:
    """How likely a band finds a pair: all guards agree, and its two fuzzy hashes agree or differ in few enough bits."""
    return similarity**guards * (similarity**2 + 0.06 * similarity * (1 - similarity))


def bands_for(similarity: float, guards: int) -> int:
    """The bands with which no more than MISSED of the pairs at the threshold are missed."""
    return int(np.ceil(np.log(MISSED) / np.log1p(-min(band_chance(similarity, guards), 1 - 1e-9))))


def guards_for(texts: int, similarity: float) -> int:
    """The least guards with which a text meets no more than RANDOM_MET random ones: a band has 4096 ** guards keys for the
    guards, and two random segments share one of their six codeword indices of 4096 with a chance of 0.7 %. Fewer bands are
    needed with fewer guards; the pairs found are as many."""
    guards = 1
    while texts * bands_for(similarity, guards) * 0.007 / 4096**guards > RANDOM_MET:
        guards += 1
    return guards


def agreeing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """agreeing, of arrays."""
    x = (a ^ b).view(np.uint64)
    x = x | x >> np.uint64(1)
    x = x | x >> np.uint64(2)
    return 16 - np.bitwise_count(x & np.uint64(0x1111111111111111)).astype(np.int64)


def _sketch(batches, width: int, min_words: int, hashes_each: int):
    known = WordHashes()
    for batch in batches:
        digests, kinds, mins = [], [], []
        for digest, text in zip(batch["digest"], batch["text"]):
            words = words_of(text)
            if len(words) < max(min_words, width):
                continue
            hashes = shingle_hashes(words, width, known)
            digests.append(digest)
            kinds.append(len(hashes))
            mins.append(fingerprint(hashes, hashes_each))
        sketch = sketch_of(np.array(mins)) if mins else np.zeros((0, len(SKETCH)), np.int64)
        yield pd.DataFrame({"digest": digests, "kinds": kinds, **dict(zip(SKETCH, sketch.T)), "mins": [m.tobytes() for m in mins]})


def _keys(batches, bands: int, guards: int):
    for batch in batches:
        if not len(batch):
            continue
        mins = np.frombuffer(b"".join(batch["mins"]), np.uint16).reshape(len(batch), -1)[:, : bands * (guards + 2)]
        for start in range(0, len(batch), 1000):
            guard, index = segments_of(mins[start : start + 1000], guards)
            rows = batch.iloc[start : start + 1000]
            each = {c: np.repeat(rows[c].to_numpy(), bands) for c in ("doc", "kinds", "one", "two")}
            five = sum(index[:, k] << 12 * k for k in range(5))
            yield pd.DataFrame({"guard": guard, "five": five, "sixth": each.pop("kinds").astype(np.int64) << 12 | index[:, 5], **each})


def _hashes(batches, width: int):
    known = WordHashes()
    for batch in batches:
        found = [shingle_hashes(words, width, known).view(np.int64) if len(words) >= width else np.zeros(0, np.int64) for words in map(words_of, batch["text"])]
        yield pd.DataFrame({"digest": batch["digest"], "hashes": found})


def agreeing(a, b):
    """How many of the sixteen groups of four bits of two columns are equal."""
    x = a.bitwiseXOR(b)
    x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
    x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
    return 16 - F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))


def least_agreeing(similarity: float, hashes: int) -> float:
    """How many of so many minimum hashes agree in four bits, at DEVIATIONS below what a pair at the threshold has in mean."""
    chance = similarity + (1 - similarity) / 16
    return hashes * chance - DEVIATIONS * (hashes * chance * (1 - chance)) ** 0.5


def _likely(similarity: float, sketch: list[str]):
    """Whether two texts may be alike enough by the numbers of their shingles, which is exact, and by their sketches."""
    agree = sum((agreeing(F.col(f"{c}_p"), F.col(f"{c}_q")) for c in sketch[1:]), agreeing(F.col(f"{sketch[0]}_p"), F.col(f"{sketch[0]}_q")))
    return (F.least("kinds_p", "kinds_q") >= F.lit(similarity) * F.greatest("kinds_p", "kinds_q")) & (agree >= least_agreeing(similarity, 16 * len(sketch)))


def _meet(batches, similarity: float):
    """``p, q`` of the texts that share a key and may be alike, from rows sorted by guard; ``p, key, kinds, one, two`` with a null q of texts whose
    key is too crowded to be compared here. No more than a guard of CROWD rows is held."""
    least, held, crowded = least_agreeing(similarity, 32), [], None
    names = ["guard", "five", "sixth", "doc", "one", "two"]

    def keys(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct keys of rows, sorted, and their rows."""
        index = np.stack([*(rows[1] >> 12 * k & 4095 for k in range(5)), rows[2] & 4095])
        fresh = np.ones(index.shape, bool)
        fresh[1:] = index[1:] != index[:1]  # all equal, or all different
        key, at = (rows[0] << 12 | index)[fresh], np.broadcast_to(np.arange(rows.shape[1]), index.shape)[fresh]
        order = np.argsort(key, kind="stable")
        return key[order], at[order]

    def alone(rows: np.ndarray, key: np.ndarray, at: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"p": rows[3][at], "q": pd.array([None] * len(at), "Int64"), "key": key, "kinds": rows[2][at] >> 12, "one": rows[4][at], "two": rows[5][at]})

    def compare(rows: np.ndarray):
        key, at = keys(rows)
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        run = np.diff(np.append(starts, len(key)))
        end = np.repeat(starts + run, run)
        many = np.repeat(run > MEETING, run)
        if many.any():
            yield alone(rows, key[many], at[many])
        kinds = rows[2] >> 12
        first = np.flatnonzero(~many & (end - np.arange(len(key)) > 1))
        step, found = 0, []
        while len(first):
            step += 1
            first = first[first + step < end[first]]
            p, q = at[first], at[first + step]
            close = np.minimum(kinds[p], kinds[q]) >= similarity * np.maximum(kinds[p], kinds[q])
            p, q = p[close], q[close]
            agree = sum(agreeing_bits(rows[c][p], rows[c][q]) for c in (4, 5))
            p, q = p[agree >= least], q[agree >= least]
            found.append(np.stack([np.minimum(rows[3][p], rows[3][q]), np.maximum(rows[3][p], rows[3][q])]))
        pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
        nothing = {c: pd.array([None] * pairs.shape[1], "Int64") for c in ("key", "kinds", "one", "two")}
        yield pd.DataFrame({"p": pairs[0], "q": pd.array(pairs[1], "Int64"), **nothing})

    for batch in batches:
        rows = batch[names].to_numpy(np.int64).T
        if crowded is not None:
            size = np.searchsorted(rows[0], crowded, "right")
            if size:
                yield alone(rows[:, :size], *keys(rows[:, :size]))
            rows = rows[:, size:]
        if not rows.shape[1]:
            continue
        crowded = None
        held = np.concatenate([held, rows], axis=1) if len(held) else rows
        last = np.searchsorted(held[0], held[0, -1], "left")  # the last guard may go on in the next batch
        if last and last >= 20_000 or last and held.shape[1] - last > CROWD:
            yield from compare(held[:, :last])
            held = held[:, last:]
            last = 0
        if not last and held.shape[1] > CROWD:
            crowded = held[0, -1]
            yield alone(held, *keys(held))
            held = []
    if len(held):
        yield from compare(held)


def texts_of(rows: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Membership ``id, digest``, and ``digest, text`` of each row; rows without key or text are left out."""
    named = rows.select(F.col(key).alias("id"), F.col(text).alias("text")).dropna()
    named = named.withColumn("digest", F.unhex(F.substring(F.sha2("text", 256), 1, 32)))  # 128 bits are as good as unique
    return named.select("id", "digest").distinct(), named.select("digest", "text")


def sketches(texts: DataFrame, width: int, min_words: int, bands: int, guards: int) -> DataFrame:
    """``digest, kinds, mins, doc`` and SKETCH of each distinct text of enough words, settled: its shingles' number, the bits by which
    candidates are compared, its minimum hashes, and a number of its own."""
    work = partial(_sketch, width=width, min_words=min_words, hashes_each=max(HASHES, bands * (guards + 2)))
    made = texts.mapInPandas(work, f"digest binary, kinds int, {', '.join(f'{c} bigint' for c in SKETCH)}, mins binary")
    once = made.groupBy("digest").agg(*(F.first(c).alias(c) for c in ("kinds", *SKETCH, "mins")))
    return settle(once.withColumn("doc", F.monotonically_increasing_id()))


def near_pairs(texts: DataFrame, made: DataFrame, width: int, similarity: float, bands: int, guards: int) -> DataFrame:
    """``x, y, similarity`` (x < y) of the digests of different texts alike enough, by their ``sketches``.

    Copies are put together by their digest before any key is made, so a copied text counts once. Candidates share a band key. A band
    travels as one row; its keys are made where it arrives, those of one text end there, and up to MEETING texts of a key are compared at
    once. Texts of a larger key go on to meet in blocks, so a key that a third of all texts have is compared by many tasks. The texts met are thinned by the sizes of
    their shingle sets, which is exact, and by how many of 32, then of 96, minimum hashes agree in four bits, at ``DEVIATIONS`` below what a pair at the threshold has; the
    rest are verified on the 64-bit hashes of all their shingles, taken once for each text. No bucket and no number of partners is capped.
    """
    shape = "guard bigint, five bigint, sixth bigint, doc bigint, one bigint, two bigint"
    keyed = made.select("doc", "kinds", *SKETCH[:2], "mins").mapInPandas(partial(_keys, bands=bands, guards=guards), shape)
    # the shuffle is by guard alone, a row for each band; the six keys of a band are made where they meet
    work = partial(_meet, similarity=similarity)
    met = settle(keyed.repartition("guard").sortWithinPartitions("guard").mapInPandas(work, "p bigint, q bigint, key bigint, kinds bigint, one bigint, two bigint").distinct())
    crowd = met.filter("q is null").select("key", F.col("p").alias("doc"), "kinds", *SKETCH[:2])
    crowd = meetings(sharing(crowd, "key"), "key", "doc", MEETING).filter(_likely(similarity, SKETCH[:2])).select(F.col("doc_p").alias("p"), F.col("doc_q").alias("q"))
    met = met.filter("q is not null").select("p", "q").union(crowd)
    met = met.select(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")).distinct()
    one, two = (made.select(F.col("doc").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("digest", "kinds", *SKETCH))) for s in "pq")
    named = met.join(one, "p").join(two, "q").filter(_likely(similarity, SKETCH))
    likely = settle(named.select(F.least("digest_p", "digest_q").alias("x"), F.greatest("digest_p", "digest_q").alias("y")))
    wanted = likely.select(F.col("x").alias("digest")).union(likely.select(F.col("y").alias("digest"))).distinct()
    needed = texts.join(wanted, "digest", "left_semi").groupBy("digest").agg(F.first("text").alias("text"))
    hashed = settle(needed.mapInPandas(partial(_hashes, width=width), "digest binary, hashes array<bigint>"))
    x, y = (hashed.select(F.col("digest").alias(s), F.col("hashes").alias(f"hashes_{s}")) for s in "xy")
    whole = likely.join(x, "x").join(y, "y").withColumn("both", F.size(F.array_intersect("hashes_x", "hashes_y")))
    score = F.col("both") / (F.size("hashes_x") + F.size("hashes_y") - F.col("both"))
    return whole.select("x", "y", score.alias("similarity")).filter(F.col("similarity") >= similarity)


def components(links: DataFrame, rounds: int = 200) -> DataFrame:
    """``node, class`` of the connected components of ``x, y`` by alternating large and small stars; the class is the
    least node. Every round is one aggregation of the links, settled in the shared folder. The rounds needed grow with the logarithm of the
    links; if ``rounds`` are not enough it fails rather than give part of the result."""
    edges = settle(links.select("x", "y").distinct())
    for _ in range(rounds):
        both = edges.select("x", "y").union(edges.select(F.col("y"), F.col("x")))
        least = both.groupBy("x").agg(F.min("y").alias("low")).select("x", F.least("x", "low").alias("low"))
        large = both.join(least, "x").filter(F.col("y") > F.col("x")).select(F.col("y").alias("x"), F.col("low").alias("y")).distinct()
        down = large.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).filter("x != y")
        floor = down.groupBy("x").agg(F.min("y").alias("low"))
        joined = down.join(floor, "x")
        small = joined.select(F.col("y").alias("x"), F.col("low").alias("y")).union(floor.select("x", F.col("low").alias("y"))).filter("x != y").distinct()
        small = settle(small)
        changed = small.join(edges.select("x", "y"), ["x", "y"], "left_anti").limit(1).count() or edges.select("x", "y").join(small, ["x", "y"], "left_anti").limit(1).count()
        edges = small
        if not changed:
            break
    else:
        raise ArithmeticError(f"components not settled after {rounds} rounds")
    roots = edges.select(F.col("y").alias("node"), F.col("y").alias("class"))
    return edges.select(F.col("x").alias("node"), F.col("y").alias("class")).union(roots).distinct()


def _plan(members: DataFrame, similarity: float, guards: int | None) -> tuple[int, int]:
    """Bands and guards for the texts that there are."""
    guards = guards_for(members.agg(F.count_distinct("digest")).first()[0], similarity) if guards is None else guards
    return bands_for(similarity, guards), guards


def near_duplicate_groups(rows: DataFrame, key: str = "id", text: str = "document", width: int = 5, similarity: float = 0.8, min_words: int = 0, guards: int | None = None) -> DataFrame:
    """One row a key: ``id, class, copies, links``.

    class is the least id of the group of texts linked by near-duplication, copies the ids with the very same text
    (itself included), links the number of different texts that are near. Texts too short for a shingle are near only to copies of
    theirs. ``guards`` follow from the number of texts unless given. Null keys and texts are left out; an empty table gives no rows.
    """
    members, texts = texts_of(rows, key, text)
    members = settle(members)
    bands, guards = _plan(members, similarity, guards)
    found = settle(near_pairs(texts, sketches(texts, width, min_words, bands, guards), width, similarity, bands, guards))
    ends = found.select(F.col("x").alias("digest")).union(found.select(F.col("y").alias("digest")))
    degree = ends.groupBy("digest").agg(F.count(F.lit(1)).alias("links"))
    roots = components(found).select(F.col("node").alias("digest"), F.col("class").alias("root"))
    kinds = members.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first"))
    kinds = kinds.join(degree, "digest", "left").join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    first = kinds.groupBy("root").agg(F.min("first").alias("class"))
    return members.join(kinds.join(first, "root").select("digest", "class", "copies", F.coalesce("links", F.lit(0)).alias("links")), "digest").drop("digest")


def near_duplicate_ids(rows: DataFrame, key: str = "id", text: str = "document", width: int = 3, similarity: float = 0.6, min_words: int = 40, guards: int | None = None) -> DataFrame:
    """``id_a, id_b`` (id_a < id_b): all keys of near texts and of equal texts of at least ``min_words`` words."""
    members, texts = texts_of(rows, key, text)
    members = settle(members)
    bands, guards = _plan(members, similarity, guards)
    made = sketches(texts, width, min_words, bands, guards)
    copies = sharing(members.join(made.select("digest"), "digest", "left_semi"), "digest")
    same = meetings(copies, "digest", "id").select(F.col("id_p").alias("id_x"), F.col("id_q").alias("id_y"))
    pairs = near_pairs(texts, made, width, similarity, bands, guards).select("x", "y")
    one, two = (members.select(F.col("digest").alias(d), F.col("id").alias(i)) for d, i in (("x", "id_x"), ("y", "id_y")))
    met = pairs.join(one, "x").join(two, "y").select("id_x", "id_y").union(same)
    return met.select(F.least("id_x", "id_y").alias("id_a"), F.greatest("id_x", "id_y").alias("id_b")).filter("id_a != id_b").distinct()
