"""Queries over the project's tables, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from lodestrata.llm import frequency, lookalike, markup, mix, neardup, pack, quality, scan_noise, split, together
from lodestrata.operators.graph import count_pairs
from lodestrata.session import table


def p1_found(spark, folder):
    return frequency.marked_terms(frequency.term_frequencies(table(spark, folder, "nodes")))


def p1_frequency(spark, folder):
    return frequency.term_frequencies(table(spark, folder, "nodes"))


def p2_found(spark, folder):
    """Pairs that are together more often than the null allows at LEVEL, and often enough by the definition of a case."""
    pairs = together.together(table(spark, folder, "nodes"), min_together=4).filter(F.col("surprise") >= -math.log10(together.LEVEL))
    return pairs.filter((F.col("n_ab") >= 4) & (F.col("n_ab") * F.col("n_records") >= 10 * F.col("n_a") * F.col("n_b"))).select("a", "b")


def p2_counts(spark, folder):
    """p2_pairs without what the null gives."""
    return p2_pairs(spark, folder).select("a", "b", "n_a", "n_b", "n_ab", "n_records", "lift")


def p2_significant(spark, folder):
    """The pairs of which no more than a twentieth are expected to be chance."""
    return together.together(table(spark, folder, "nodes")).filter("q_value <= 0.05")


def p2_pairs(spark, folder):
    return together.together(table(spark, folder, "nodes"))


def p2_recorded(spark, folder):
    """Every pair's records in common beside the count that was recorded for it."""
    pairs = count_pairs(together.incidence(table(spark, folder, "nodes")), "item", "record").withColumnRenamed("n", "n_ab")
    edges = table(spark, folder, "edges").select(frequency.normal_term(F.col("a")).alias("x"), frequency.normal_term(F.col("b")).alias("y"), "weight")
    recorded = edges.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.sum("weight").alias("recorded"))
    both = pairs.join(recorded, ["a", "b"], "full")
    return both.select("a", "b", F.coalesce("n_ab", F.lit(0)).alias("n_ab"), F.coalesce("recorded", F.lit(0)).alias("recorded"))


def p3_found(spark, folder):
    return neardup.near_duplicate_ids(table(spark, folder, "chunks"))


def p3_groups(spark, folder):
    return neardup.near_duplicate_groups(table(spark, folder, "chunks"))


def p4_found(spark, folder):
    return lookalike.look_alike_ids(table(spark, folder, "chunks"))


def p4_groups(spark, folder):
    return lookalike.look_alike_groups(table(spark, folder, "chunks"))


def p4_normalized(spark, folder):
    return lookalike.normalized(table(spark, folder, "chunks"))


def p5_found(spark, folder):
    return scan_noise.noisy_lines(table(spark, folder, "chunks"))


def p5_repaired(spark, folder):
    repaired = scan_noise.repair(table(spark, folder, "chunks"))
    sums = [F.size(F.filter(F.col(f"noise.{k}"), lambda x: x)).alias(k) for k in scan_noise.NOISE]
    return repaired.select("id", "text", *sums)


def p6_found(spark, folder):
    return markup.markup_kinds(table(spark, folder, "chunks"))


def p6_clean(spark, folder):
    return markup.clean_markup(table(spark, folder, "chunks"))


def p7_found(spark, folder):
    return split.oversized_ids(table(spark, folder, "chunks"))


def p7_pieces(spark, folder):
    return split.split_oversized(table(spark, folder, "chunks"))


def p7_sizes(spark, folder):
    """Of each record: the words of its pieces without overlaps, whether all are within the limit, numbered in order and stretches of the text, and overlap only behind the first."""
    chunks = table(spark, folder, "chunks")
    given = chunks.select("id", F.col("document").alias("given")).distinct()
    pieces = split.split_oversized(chunks).join(given, "id").groupBy("id").agg(
        F.sum(F.col("words") - F.col("overlap_words")).alias("words"), (F.max("words") <= 500).alias("within"), (F.max("piece_no") + 1 == F.count_distinct("piece_no")).alias("numbered"),
        F.bool_and(F.contains("given", "text")).alias("stretches"), F.bool_and((F.col("piece_no") > 0) | (F.col("overlap_words") == 0)).alias("first_whole"),
    )
    return pieces


def p8_pack(spark, folder):
    return pack.pack(table(spark, folder, "documents"), table(spark, folder, "pack_sizes"))


def p8_fill(spark, folder):
    return pack.filling(p8_pack(spark, folder))


def p8_items(spark, folder):
    """Of each capacity: the documents placed, whether each token stands in one place, and whether all containers hold."""
    packed = p8_pack(spark, folder)
    used = packed.groupBy("pack_name", "capacity_tokens", "container").agg(F.sum("tokens").alias("used"), F.max(F.col("place") + F.col("tokens")).alias("end"))
    whole = packed.groupBy("pack_name", "doc_id").agg((F.max(F.col("first_token") + F.col("tokens")) == F.sum("tokens")).alias("once"))
    fits = used.groupBy("pack_name", "capacity_tokens").agg(F.bool_and((F.col("used") <= F.col("capacity_tokens")) & (F.col("end") == F.col("used"))).alias("fits"))
    return fits.join(whole.groupBy("pack_name").agg(F.count(F.lit(1)).alias("documents"), F.bool_and("once").alias("once")), "pack_name")


def p9_within(spark, folder):
    """Of each source that a target asks for and that has documents: whether it is used, and no document of it oftener than it may."""
    chosen, shares = mix.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))
    times = chosen.groupBy("source").agg(F.max("times").alias("times"))
    return shares.filter("target_share > 0 and tokens_available > 0").join(times, "source", "left").select("source", "max_repeats", (F.col("times") >= 1).alias("used"), (F.col("times") <= F.col("max_repeats")).alias("within"))


def p9_mix(spark, folder):
    return mix.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[0]


def p9_shares(spark, folder):
    return mix.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[1]


def p9_temperature(spark, folder):
    return mix.temperature_mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


def p10_found(spark, folder):
    return quality.not_language(table(spark, folder, "documents"))


def p10_quality(spark, folder):
    return quality.text_quality(table(spark, folder, "documents"))


def p10_counts(spark, folder):
    return p10_quality(spark, folder).select("doc_id", "n_chars", "n_words", "n_lines")


def p10_labels(spark, folder):
    """How many documents of each label given by hand came out as which kind; a document with two labels counts for both."""
    labels = table(spark, folder, "quality_labels").select("doc_id", "label").dropna().distinct()
    return labels.join(p10_quality(spark, folder).select("doc_id", "kind"), "doc_id").groupBy("label", "kind").agg(F.count(F.lit(1)).alias("documents"))


def p10_spread(spark, folder):
    """p10_quality with the chunks of every text above 1,024 characters spread and merged over the executors."""
    return quality.text_quality(table(spark, folder, "documents"), chunk=256, spread=4)


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_frequency, p2_found, p2_pairs, p2_counts, p2_significant, p2_recorded, p3_found, p3_groups, p4_found, p4_groups, p4_normalized, p5_found, p5_repaired, p6_found, p6_clean,
        p7_found, p7_pieces, p7_sizes, p8_pack, p8_fill, p8_items, p9_mix, p9_within, p9_shares, p9_temperature, p10_found, p10_quality, p10_counts, p10_labels, p10_spread,
    )
}

_TERM = r"lower(regexp_replace({}, '^[ \t\r\n\v\f]+|[ \t\r\n\v\f]+$', '', 'g'))"
_TOKENS = f"""
WITH rows_ AS (SELECT {_TERM.format("entity")} AS term, list_filter(chunks, lambda x: x IS NOT NULL) AS ids FROM nodes),
tokens AS (SELECT term, unnest(ids) AS id FROM rows_),
total AS (SELECT count(DISTINCT id) AS total_records FROM tokens),
counted AS (SELECT term, count(id) AS occurrences, count(DISTINCT id) AS records FROM
  (SELECT term, id FROM tokens UNION ALL SELECT DISTINCT term, NULL FROM rows_) WHERE term IS NOT NULL GROUP BY term)"""
_PAIRS = f"""
WITH links AS (SELECT DISTINCT item, record FROM (SELECT {_TERM.format("entity")} AS item, unnest(chunks) AS record FROM nodes) WHERE item IS NOT NULL AND record IS NOT NULL),
items AS (SELECT item, count(*) AS n FROM links GROUP BY item),
total AS (SELECT count(DISTINCT record) AS n_records FROM links),
pairs AS (SELECT x.item AS a, y.item AS b, count(*) AS n_ab FROM links x JOIN links y ON x.record = y.record AND x.item < y.item GROUP BY 1, 2)"""

SQL = {
    "p1_frequency": _TOKENS + " SELECT term, occurrences, records, total_records, records < 3 AS is_rare, records > total_records * 0.1::DOUBLE AS is_common FROM counted, total",
    "p1_found": _TOKENS + " SELECT term AS entity, 'rare' AS mark FROM counted WHERE records < 3 UNION ALL SELECT term, 'common' FROM counted, total WHERE records * 10 > total_records",
    "p2_found": _PAIRS + " SELECT p.a, p.b FROM pairs p JOIN items x ON p.a = x.item JOIN items y ON p.b = y.item, total WHERE n_ab >= 4 AND n_ab * n_records >= 10 * x.n * y.n",
    "p2_recorded": _PAIRS + f""", recorded AS (SELECT least(x, y) AS a, greatest(x, y) AS b, sum(weight)::BIGINT AS recorded FROM
  (SELECT {_TERM.format("a")} AS x, {_TERM.format("b")} AS y, weight FROM edges) GROUP BY 1, 2)
SELECT coalesce(p.a, r.a) AS a, coalesce(p.b, r.b) AS b, coalesce(n_ab, 0) AS n_ab, coalesce(recorded, 0) AS recorded FROM pairs p FULL JOIN recorded r ON p.a = r.a AND p.b = r.b""",
    "p3_found": """
WITH docs AS (SELECT DISTINCT id, document FROM chunks WHERE id IS NOT NULL AND document IS NOT NULL),
texts AS (SELECT document, row_number() OVER () AS t FROM (SELECT DISTINCT document FROM docs)),
words AS (SELECT t, regexp_extract_all(lower(document), '[a-z0-9]+') AS w FROM texts),
kinds AS (SELECT DISTINCT t, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT t, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 40)),
sizes AS (SELECT t, count(*) AS n FROM kinds GROUP BY t),
shared AS (SELECT x.t AS x, y.t AS y, count(*) AS k FROM kinds x JOIN kinds y ON x.s = y.s AND x.t < y.t GROUP BY 1, 2),
near AS (SELECT x, y FROM shared JOIN sizes p ON x = p.t JOIN sizes q ON y = q.t WHERE k >= 0.6 * (p.n + q.n - k) UNION ALL SELECT t, t FROM sizes)
SELECT DISTINCT least(a.id, b.id) AS id_a, greatest(a.id, b.id) AS id_b FROM near JOIN texts u ON x = u.t JOIN texts v ON y = v.t
JOIN docs a ON a.document = u.document JOIN docs b ON b.document = v.document WHERE a.id <> b.id""",
    "p2_counts": _PAIRS + " SELECT p.a, p.b, x.n AS n_a, y.n AS n_b, n_ab, n_records, n_ab * n_records / (x.n * y.n) AS lift FROM pairs p JOIN items x ON p.a = x.item JOIN items y ON p.b = y.item, total",
    "p3_groups": """
WITH RECURSIVE docs AS (SELECT DISTINCT id, document FROM chunks WHERE id IS NOT NULL AND document IS NOT NULL),
texts AS (SELECT document, row_number() OVER (ORDER BY document) AS t FROM (SELECT DISTINCT document FROM docs)),
words AS (SELECT t, regexp_extract_all(lower(document), '[a-z0-9]+') AS w FROM texts),
kinds AS (SELECT DISTINCT t, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT t, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)),
sizes AS (SELECT t, count(*) AS n FROM kinds GROUP BY t),
shared AS (SELECT x.t AS x, y.t AS y, count(*) AS k FROM kinds x JOIN kinds y ON x.s = y.s AND x.t < y.t GROUP BY 1, 2),
near AS (SELECT x, y FROM shared JOIN sizes p ON x = p.t JOIN sizes q ON y = q.t WHERE k >= 0.8 * (p.n + q.n - k)),
both_ AS (SELECT x, y FROM near UNION ALL SELECT y, x FROM near),
reach AS (SELECT t AS x, t AS y FROM texts UNION SELECT r.x, b.y FROM reach r JOIN both_ b ON r.y = b.x),
firsts AS (SELECT t, min(id) AS id, count(*) AS copies FROM docs JOIN texts USING (document) GROUP BY t),
classes AS (SELECT r.x AS t, min(f.id) AS class FROM reach r JOIN firsts f ON r.y = f.t GROUP BY 1),
degrees AS (SELECT x AS t, count(*) AS links FROM both_ GROUP BY 1)
SELECT d.id, class, copies, coalesce(links, 0) AS links FROM docs d JOIN texts USING (document) JOIN classes USING (t) JOIN firsts f USING (t) LEFT JOIN degrees USING (t)""",
    "p7_sizes": r"SELECT DISTINCT id, len(regexp_extract_all(document, '[^ \t\r\n]+'))::BIGINT AS words, true AS within, true AS numbered, true AS stretches, true AS first_whole FROM chunks WHERE id IS NOT NULL AND document IS NOT NULL",
    "p8_items": "SELECT DISTINCT pack_name, capacity_tokens, (SELECT count(DISTINCT doc_id) FROM documents) AS documents, true AS fits, true AS once FROM pack_sizes WHERE capacity_tokens > 0",
    "p9_within": "SELECT source, max_repeats, true AS used, true AS within FROM mix_targets WHERE target_share > 0 AND source IN (SELECT lower(trim(source)) FROM documents WHERE text <> '')",
    "p10_counts": r"SELECT doc_id, length(text)::BIGINT AS n_chars, len(regexp_extract_all(text, '[^ \t\r\n\f\v\x{a0}]+'))::BIGINT AS n_words, (length(text) - length(replace(text, chr(10), '')) + 1)::BIGINT AS n_lines FROM documents WHERE text IS NOT NULL",
    "p7_found": "SELECT DISTINCT id FROM chunks WHERE len(regexp_extract_all(document, '[^ \\t\\r\\n]+')) > 500 AND id IS NOT NULL",
}
