"""SQL that gives the rows of the queries, written for an engine without look-around and built from sets rather than arrays."""

from __future__ import annotations

from lodestrata.functions import patterns as P
from lodestrata.functions.entities import STOP_WORDS
from lodestrata.operators.search import DIMENSIONS, query_words
from lodestrata.plans.queries import ASKED, QUERY


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(to)}, 'g')"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {lit(pattern)})"


def strip(x: str) -> str:
    return sub(x, rf"^{P.SPACE}+|{P.SPACE}+\z")


def words(x: str) -> str:
    return f"len(regexp_extract_all({x}, {lit(P.NONSPACE + '+')}))"


DOCS = "docs AS (SELECT DISTINCT id, document FROM chunks)"


def lines_of(source: str = "docs", column: str = "document", name: str = "ln") -> str:
    """CTEs ending in ``name(id, pos, line)``, pos from 0."""
    return f"""{name}_a AS (SELECT id, string_split_regex({column}, {lit(P.LINE_BREAK)}) AS p FROM {source}),
{name}_b AS (SELECT id, CASE WHEN p[len(p)] = '' THEN list_slice(p, 1, len(p) - 1) ELSE p END AS p FROM {name}_a),
{name}_c AS (SELECT id, p, unnest(range(0, len(p))) AS pos FROM {name}_b),
{name} AS (SELECT id, pos, p[pos + 1] AS line FROM {name}_c)"""


# a negative look-ahead for digits only, as alternatives by how many digits come first
NOT_DIGITS = "|".join(rf"{P.DIGIT}{{{k}}}[^<\p{{Nd}}][^<]{{0,{9 - k}}}" for k in range(10))
MATH_SUP, MATH_SUB = rf"(?i)<sup>({NOT_DIGITS})</sup>", rf"(?i)<sub>({NOT_DIGITS})</sub>"


def span(x):
    return sub(x, P.SPAN_TAG)


def math(x):
    return sub(sub(x, MATH_SUP, r"$^{\1}$"), MATH_SUB, r"$_{\1}$")


def ocr(x):
    return f"replace({sub(sub(sub(x, P.ANY_SUP), P.LINE_TAG, ' '), P.UNSEEN)}, chr(160), ' ')"


STEPS = {
    "span": span, "double_sup": lambda x: sub(x, P.DOUBLE_FOOTNOTE), "residual": lambda x: sub(x, P.LEFT_FOOTNOTE), "math": math,
    "footnote": lambda x: sub(x, P.FOOTNOTE), "image": lambda x: sub(x, P.PAGE_IMAGE), "ocr": ocr,
}


def all_steps(x: str) -> str:
    for step in STEPS.values():
        x = step(x)
    return x


def page(ctes: str, source: str) -> str:
    return f"""WITH {ctes}, {lines_of(source)},
s AS (SELECT id, pos, line, {strip("line")} AS t FROM ln), total AS (SELECT id, count(*) AS n FROM s GROUP BY id),
freq AS (SELECT id, t, count(*) AS k FROM s WHERE t <> '' AND length(t) < 72 AND NOT {has("t", P.NUMBERED_CODE)} GROUP BY id, t),
heads AS (SELECT f.id, t FROM freq f JOIN total USING (id) WHERE k >= greatest(3, n // 30) AND NOT {has("t", P.FORMULA_SIGN)}),
kept AS (SELECT s.id, pos, line FROM s LEFT JOIN heads h ON s.id = h.id AND s.t = h.t WHERE h.t IS NULL AND NOT {has("line", P.PAGE_NUMBER)})
SELECT d.id, coalesce(string_agg(line, chr(10) ORDER BY pos), '') AS text FROM (SELECT DISTINCT id FROM docs) d LEFT JOIN kept k ON d.id = k.id GROUP BY d.id"""


def heading(x: str) -> str:
    content = sub(x, P.ATX_MARK)
    bare = strip(sub(x, P.EMPHASIS))
    letters = "length(" + sub(x, r"[^\p{L}]") + ")"
    return f"""CASE WHEN {x} = '' OR {has(x, P.NUMBERED_CODE)} THEN false
WHEN {has(x, P.ATX)} THEN NOT (starts_with({content}, '$$') OR starts_with({content}, '\\[')) AND {has(content, P.PROSE_WORD)} AND NOT {has(content, P.PSEUDOCODE)}
WHEN length({x}) > 80 THEN false WHEN {has(x, P.NUMBERED_HEADING)} OR {has(x, P.NAMED_HEADING)} THEN true
WHEN {has(bare, P.SECTION_NAME)} THEN true ELSE {letters} >= 4 AND length({x}) < 60 AND upper({x}) = {x} END"""


HEADED = f"""WITH {DOCS}, {lines_of()}, st AS (SELECT id, pos, line, {strip("line")} AS t FROM ln), hl AS (SELECT id, pos, line, t, {heading("t")} AS h FROM st)"""
SECTIONS = HEADED + f""", ns AS (SELECT *, sum(h::INT) OVER (PARTITION BY id ORDER BY pos) AS sec FROM hl),
names AS (SELECT id, sec, {sub("t", P.ATX_MARK)} AS heading FROM ns WHERE h),
body AS (SELECT id, sec, pos, line, row_number() OVER (PARTITION BY id, sec ORDER BY pos) AS k FROM ns WHERE NOT h),
sn AS (SELECT id, sec, row_number() OVER (PARTITION BY id ORDER BY sec) - 1 AS section_no FROM (SELECT DISTINCT id, sec FROM body)),
sections AS (SELECT sn.id, sn.sec, section_no, coalesce(heading, '') AS heading FROM sn LEFT JOIN names USING (id, sec))"""
CODE = SECTIONS + f""", marked AS (SELECT id, sec, k, CASE WHEN {has("line", P.NUMBERED_CODE)} THEN {sub("line", P.SPACE + "+" + chr(92) + "z")} ELSE line END AS line, {has("line", P.NUMBERED_CODE)} AS c FROM body),
edges_ AS (SELECT *, (c <> coalesce(lag(c) OVER w, NOT c))::INT AS turn FROM marked WINDOW w AS (PARTITION BY id, sec ORDER BY k)),
runs AS (SELECT *, sum(turn) OVER (PARTITION BY id, sec ORDER BY k) AS run FROM edges_),
blocks AS (SELECT id, sec, run, CASE WHEN bool_and(c) THEN '```' || chr(10) || string_agg(line, chr(10) ORDER BY k) || chr(10) || '```' ELSE string_agg(line, chr(10) ORDER BY k) END AS t FROM runs GROUP BY id, sec, run),
fenced AS (SELECT id, sec, string_agg(t, chr(10) ORDER BY run) AS text FROM blocks GROUP BY id, sec)"""
NUMBERED = "list_filter(list_transform({}, lambda x: {}), lambda x: x <> '')"
PARAGRAPHS = CODE + f""", pars_a AS (SELECT id, sec, {NUMBERED.format(f"string_split_regex(text, {lit(chr(10) + P.SPACE + '*' + chr(10))})", strip("x"))} AS p FROM fenced),
pars AS (SELECT id, sec, p[i + 1] AS paragraph, i AS place FROM (SELECT id, sec, p, unnest(range(0, len(p))) AS i FROM pars_a))"""


def sentence_list(x: str) -> str:
    split = f"string_split(regexp_replace({x}, {lit('([.!?])' + P.SPACE + '+')}, '\\1' || chr(1), 'g'), chr(1))"
    return f"CASE WHEN starts_with({x}, '$$') THEN [{x}] ELSE {NUMBERED.format(split, strip('x'))} END"


SENTENCES = PARAGRAPHS + f""", sents_a AS (SELECT id, sec, place, {sentence_list("paragraph")} AS s FROM pars),
sents_b AS (SELECT id, sec, place, s, unnest(range(0, len(s))) AS i FROM sents_a),
sents AS (SELECT id, sec, s[i + 1] AS sentence, row_number() OVER (PARTITION BY id, sec ORDER BY place, i) AS k FROM sents_b),
sized AS (SELECT *, {words("sentence")} AS w, coalesce(lag({words("sentence")}) OVER (PARTITION BY id, sec ORDER BY k), 0) AS w0 FROM sents)"""


def fold(limit: int) -> str:
    """CTEs ending in ``ranges(id, sec, first, last)`` and ``chunked(id, sec, chunk_no, first, last, text)``."""
    full = f"f.words + s.w >= {limit}"
    moves = f"({full} AND s.k - f.start + 1 > 2)"
    return SENTENCES.replace("WITH ", "WITH RECURSIVE ", 1) + f""", f AS (
SELECT id, sec, 0::BIGINT AS k, 1::BIGINT AS start, 0::BIGINT AS words, NULL::BIGINT AS first, NULL::BIGINT AS last FROM (SELECT DISTINCT id, sec FROM sents)
UNION ALL SELECT s.id, s.sec, s.k, CASE WHEN {moves} THEN s.k - 1 ELSE f.start END, CASE WHEN {moves} THEN s.w0 + s.w ELSE f.words + s.w END,
CASE WHEN {full} THEN f.start END, CASE WHEN {full} THEN s.k END FROM f JOIN sized s ON f.id = s.id AND f.sec = s.sec AND s.k = f.k + 1),
ends AS (SELECT id, sec, max(k) AS n FROM f GROUP BY id, sec),
ranges AS (SELECT id, sec, first, last FROM f WHERE first IS NOT NULL
UNION SELECT f.id, f.sec, f.start, f.k FROM f JOIN ends e ON f.id = e.id AND f.sec = e.sec AND f.k = e.n WHERE e.n > 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY id, sec ORDER BY last, first) - 1 AS chunk_no FROM ranges),
chunked AS (SELECT r.id, r.sec, r.chunk_no, r.first, r.last, string_agg(s.sentence, ' ' ORDER BY s.k) AS text
FROM numbered r JOIN sents s ON r.id = s.id AND r.sec = s.sec AND s.k BETWEEN r.first AND r.last GROUP BY ALL)"""


def merged(limit: int) -> str:
    """CTEs ending in ``final(id, sec, chunk_no, chunk)``."""
    whole = f"(m.done[len(m.done)] || ' ' || c.text)"
    stripped = strip("c.text")
    orphan = f"coalesce(regexp_matches(({sentence_list(stripped)})[1], {lit(P.ORPHAN)}), false)"
    before = sentence_list(strip("m.done[len(m.done)]"))
    return fold(limit) + f""", m AS (SELECT id, sec, chunk_no, [text] AS done FROM chunked WHERE chunk_no = 0
UNION ALL SELECT c.id, c.sec, c.chunk_no, CASE WHEN NOT {orphan} THEN list_append(m.done, c.text)
WHEN {words(whole)} <= {int(limit * 1.2)} THEN list_append(list_slice(m.done, 1, len(m.done) - 1), {whole})
WHEN len({before}) >= 2 THEN list_append(m.done, list_last({before}) || ' ' || c.text) ELSE list_append(m.done, c.text) END
FROM m JOIN chunked c ON m.id = c.id AND m.sec = c.sec AND c.chunk_no = m.chunk_no + 1),
lasts AS (SELECT id, sec, max(chunk_no) AS chunk_no FROM m GROUP BY id, sec),
lists AS (SELECT m.id, m.sec, done, unnest(range(0, len(done))) AS chunk_no FROM m JOIN lasts USING (id, sec, chunk_no)),
final AS (SELECT id, sec, chunk_no, done[chunk_no + 1] AS chunk FROM lists)"""


def noise(source: str, column: str, key: str) -> str:
    """CTEs ending in ``judged(key, tables, toc, urls, prose, keep)``."""
    return f"""{lines_of(f"(SELECT {key} AS id, {column} AS document FROM {source})", "document", "nl")},
nt AS (SELECT id, pos, line, {strip("line")} AS t, starts_with({strip("line")}, '```') AS fence FROM nl),
nf AS (SELECT *, sum(fence::INT) OVER (PARTITION BY id ORDER BY pos) % 2 = 1 AS inside FROM nt),
tally AS (SELECT id, count(*) FILTER (t <> '') AS n, count(*) FILTER (starts_with(t, '|')) AS rows_, count(*) FILTER (t <> '' AND {has("line", P.TOC_ENTRY)}) AS entries,
count(*) FILTER (t <> '' AND {has("line", P.BARE_URL)}) AS links_, coalesce(sum(len(regexp_extract_all(line, {lit(P.PROSE_WORD)}))) FILTER (NOT fence AND NOT inside), 0) AS prose FROM nf GROUP BY id),
judged AS (SELECT t.id, d.{column} AS text, t.n >= 2 AND rows_ >= 0.5 * t.n AS tables, t.n >= 3 AND entries >= 0.5 * t.n AS toc, t.n >= 2 AND links_ >= 0.6 * t.n AS urls, prose::INT AS prose,
(prose >= 25 OR prose >= 5 AND {has(f"d.{column}", P.LATEX)}) AS enough FROM tally t JOIN {source} d ON t.id = d.{key})"""


def chunks_sql(limit: int) -> str:
    name = strip(sub("heading", P.HEADING_PAGE))
    return merged(limit) + f""", bodies AS (SELECT f.id, section_no, chunk_no, {name} AS heading, CASE WHEN {name} = '' THEN chunk ELSE {name} || chr(10) || chunk END AS body
FROM final f JOIN sections s ON f.id = s.id AND f.sec = s.sec WHERE NOT {has(strip(sub("heading", P.EMPHASIS)), P.BOILERPLATE)}),
keyed AS (SELECT *, row_number() OVER () AS n FROM bodies), {noise("keyed", "body", "n")},
smart AS (SELECT b.id, section_no, chunk_no, heading, body FROM keyed b JOIN judged j ON b.n = j.id WHERE NOT tables AND NOT toc AND NOT urls AND enough)"""


def suffix(x: str) -> str:
    return f"lower(regexp_extract({filename(x)}, '^.+\\.([^.]+)$', 1))"


def filename(x: str) -> str:
    return f"regexp_extract({x}, '[^/]*$')"


def stem(x: str) -> str:
    return f"regexp_replace({filename(x)}, '^(.+)\\.[^.]*$', '\\1')"


def real(x: str, pattern: str) -> str:
    t = strip(f"coalesce({x}, '')")
    return f"CASE WHEN {has(t, pattern)} THEN '' ELSE {t} END"


LINKS = f"links AS (SELECT DISTINCT entity, chunk FROM (SELECT lower({strip('entity')}) AS entity, unnest(chunks) AS chunk FROM nodes) WHERE entity IS NOT NULL AND chunk IS NOT NULL)"
GRAPH = f"""graph AS (SELECT least(x, y) AS a, greatest(x, y) AS b, sum(weight)::BIGINT AS weight FROM (SELECT lower({strip('a')}) AS x, lower({strip('b')}) AS y, weight FROM edges)
WHERE x IS NOT NULL AND y IS NOT NULL AND weight IS NOT NULL AND x <> y GROUP BY 1, 2),
adj AS (SELECT a AS node, b AS neighbour, weight FROM graph UNION ALL SELECT b, a, weight FROM graph),
ranked AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY weight DESC, neighbour) AS rank FROM adj)"""
ASKED_SQL = "asked(node, place) AS (VALUES " + ", ".join(f"({lit(x)}, {i})" for i, x in enumerate(ASKED)) + ")"


def expand(hops: int) -> str:
    second = "UNION ALL SELECT r.neighbour, r.weight * 0.5 FROM hop1 h JOIN ranked r ON h.neighbour = r.node WHERE r.rank <= 3" if hops >= 2 else ""
    return f"""{GRAPH}, {ASKED_SQL}, hop1 AS (SELECT r.* FROM ranked r JOIN asked USING (node) WHERE rank <= 10),
found AS (SELECT neighbour AS concept, weight::DOUBLE AS score FROM hop1 {second}),
best AS (SELECT concept, sum(score) AS score FROM found WHERE concept NOT IN (SELECT node FROM asked) GROUP BY concept ORDER BY score DESC, concept LIMIT 10),
expanded AS (SELECT concept, score, row_number() OVER (ORDER BY score DESC, concept) AS rank FROM best)"""


def bucket(x: str) -> str:
    return f"(('0x' || substr(md5({x}), 1, 6))::INT % {DIMENSIONS})"


ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def search(query: str) -> str:
    """CTEs from ``query_words(word)`` on; query is SQL for that table."""
    return f"""qb AS (SELECT {bucket("word")} AS b, count(*) AS n FROM ({query}) GROUP BY 1), qn AS (SELECT sqrt(sum(n * n)) AS n FROM qb),
dw AS (SELECT id, document, unnest(regexp_extract_all({ASCII_LOWER.format("document")}, '[a-z0-9]+')) AS word FROM docs WHERE document IS NOT NULL),
db AS (SELECT id, document, {bucket("word")} AS b, count(*) AS n FROM dw GROUP BY 1, 2, 3), dn AS (SELECT id, document, sqrt(sum(n * n)) AS n FROM db GROUP BY 1, 2),
hits AS (SELECT id, document, sum(db.n * qb.n) AS dot FROM db JOIN qb USING (b) GROUP BY 1, 2),
scored AS (SELECT dn.id, round(coalesce(dot, 0) / (dn.n * qn.n), 9) AS similarity FROM dn LEFT JOIN hits USING (id, document), qn),
top AS (SELECT * FROM scored ORDER BY similarity DESC, id LIMIT 10) SELECT row_number() OVER (ORDER BY similarity DESC, id) AS rank, id, similarity FROM top"""


STOP = rf"(?i)(^|[^\p{{L}}\p{{N}}'-])(?:{'|'.join(STOP_WORDS)})([^\p{{L}}\p{{N}}'-]|$)"
# without look-around a separator is used up by one match, so a second pass takes the stop words that stood next to another
ENTITIES = f"""WITH {DOCS}, spaced AS (SELECT id, {sub("lower(document)", r"([^\p{L}\p{N}'-])", r"\1\1")} AS t FROM docs),
cut AS (SELECT id, string_split_regex({sub("t", STOP, r"\1|\2")}, {lit(r"[^\p{L}\p{N} '-]+")}) AS parts FROM spaced),
phrases AS (SELECT id, list_filter(list_transform(parts, lambda x: trim(regexp_replace(x, ' +', ' ', 'g'))), lambda x: length(x) >= 4 AND {has("x", r"\p{L}")}) AS p FROM cut),
each AS (SELECT id, p, unnest(range(0, len(p))) AS i FROM phrases), firsts AS (SELECT id, p[i + 1] AS entity, min(i) AS i FROM each GROUP BY 1, 2)"""

FILES = "once AS (SELECT source, max(mtime) AS mtime FROM raw_files GROUP BY source)"
STATUS = FILES + """, stored AS (SELECT source, max(mtime) AS stored FROM manifest WHERE mtime IS NOT NULL GROUP BY source),
status AS (SELECT o.source, o.mtime, CASE WHEN stored IS NULL THEN 'new' WHEN stored >= o.mtime THEN 'skip' ELSE 'changed' END AS status FROM once o LEFT JOIN stored USING (source))"""
PER_SOURCE = "per_source AS (SELECT coalesce(source, '') AS source, count(*) AS chunks FROM chunks GROUP BY 1)"
REPORT = f"""WITH {PER_SOURCE}, kinds AS (SELECT *, lower({strip('suffix')}) AS kind FROM raw_files),
one AS (SELECT source, max(filename) AS filename, max(kind) AS kind, max(length) AS length FROM kinds WHERE kind IN ('pdf', 'txt', 'md', 'markdown', 'csv') GROUP BY source),
shown AS (SELECT o.source, CASE WHEN length(filename) > 52 THEN filename[:51] || '…' ELSE filename END AS name, CASE WHEN kind <> 'pdf' THEN 'n/a' WHEN length IS NULL THEN 'MISSING' WHEN length < 500 THEN 'EMPTY' ELSE (length // 1024)::VARCHAR || ' KB' END AS extracted,
coalesce(chunks, 0) AS chunks FROM (SELECT source, filename, kind, length FROM one) o LEFT JOIN per_source USING (source)),
report AS (SELECT *, CASE WHEN extracted NOT IN ('MISSING', 'EMPTY') AND chunks > 0 THEN 'OK' ELSE concat_ws(', ', CASE extracted WHEN 'MISSING' THEN 'no extracted text' WHEN 'EMPTY' THEN 'extracted text is empty' END, CASE WHEN chunks = 0 THEN 'no chunks' END) END AS issues FROM shown)"""
ORPHANS = "orphans AS (SELECT p.source, p.chunks FROM per_source p WHERE p.source NOT IN (SELECT source FROM raw_files WHERE source IS NOT NULL))"
DISTANCE = "round(list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE))), 6)"
STEM_PARTS = f"replace(coalesce(title, 'Notes_ draft'), ': ', '_ ') || ' -- A_B_ Writer -- Press -- {P.ARCHIVE_TAG.replace(chr(39), chr(39) * 2)}'"


def names(stem_sql: str, part: int) -> str:
    found = f"regexp_extract({strip(stem_sql)}, {lit(P.ARCHIVE_STEM)}, {part})"
    initials = f"regexp_replace({found}, '\\b([A-Z])_([A-Z])_($|[^A-Za-z0-9_])', '\\1.\\2.\\3', 'g')"
    return strip(f"regexp_replace({initials}, {lit('_(' + P.SPACE + ')')}, ':\\1', 'g')")


def first_of(*xs: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({x}, '')" for x in xs) + ", '')"


SQL = {f"q_clean_{name}": f"WITH {DOCS} SELECT id, {step('document')} AS text FROM docs" for name, step in STEPS.items()} | {
    "q_clean_page": page(DOCS, "docs"),
    "q_clean_all": page(f"{DOCS}, steps AS (SELECT id, {all_steps('document')} AS document FROM docs)", "steps"),
    "q_scan_suffix": f"SELECT DISTINCT source, {filename('source')} AS filename, {suffix('source')} AS suffix FROM raw_files WHERE {suffix('source')} IN ('pdf', 'txt', 'md', 'markdown', 'csv')",
    "q_csv_serialize": "SELECT c_custkey, concat_ws(' | ', 'c_custkey: ' || c_custkey, CASE WHEN trim(c_name) <> '' THEN 'c_name: ' || c_name END, 'c_nationkey: ' || c_nationkey, CASE WHEN trim(c_mktsegment) <> '' THEN 'c_mktsegment: ' || c_mktsegment END) AS text FROM customer",
    "q_csv_text": "SELECT n_regionkey, string_agg('key: ' || n_nationkey || ' | name: ' || n_name || ' | region: ' || n_regionkey, chr(10) || chr(10) ORDER BY n_nationkey || ',' || n_name) AS text FROM nation GROUP BY n_regionkey",
    "q_cache_key": "SELECT DISTINCT source, regexp_replace(regexp_replace(source, '\\.[^./]*$', '') || '.md', '[/\\\\]', '__', 'g') AS cache_key FROM raw_files",
    "q_cache_hit": f"WITH {FILES}, c AS (SELECT source, max(mtime) AS cached FROM manifest WHERE mtime IS NOT NULL GROUP BY source) SELECT o.source, CASE WHEN cached IS NULL THEN 'missing' WHEN cached >= mtime THEN 'hit' ELSE 'stale' END AS status FROM once o LEFT JOIN c USING (source)",
    "q_cache_misaligned": f"WITH d AS (SELECT DISTINCT id, source, document FROM chunks) SELECT id, source, len(regexp_extract_all(lower({stem('source')}), '[a-z]{{4,}}')) > 0 AND len(list_filter(regexp_extract_all(lower({stem('source')}), '[a-z]{{4,}}'), lambda w: contains(lower(array_to_string(list_slice(string_split_regex(document, {lit(P.LINE_BREAK)}), 1, 200), chr(10))), w))) = 0 AS flag FROM d",
    "q_upsert_latest": "SELECT collection_name, id, document, source, mtime, ingested_at FROM (SELECT *, row_number() OVER (PARTITION BY collection_name, id ORDER BY ingested_at DESC NULLS LAST, mtime DESC NULLS LAST, document DESC, source DESC) AS r FROM chunks) WHERE r = 1",
    "q_replace_sources": f"WITH {STATUS}, changed AS (SELECT source, mtime FROM status WHERE status = 'changed'), k AS (SELECT DISTINCT collection_name, id, source, chunk_index, mtime FROM chunks) SELECT * FROM k WHERE source IS NULL OR source NOT IN (SELECT source FROM changed) UNION ALL SELECT DISTINCT collection_name, id, source, chunk_index, c.mtime FROM k JOIN changed c USING (source)",
    "q_reingest_shrunk": f"WITH {STATUS} SELECT DISTINCT collection_name, id, source FROM chunks WHERE source IS NULL OR {suffix('source')} = 'pdf' OR source NOT IN (SELECT source FROM status WHERE status = 'changed')",
    "q_ingest_texts": "SELECT DISTINCT collection_name, id, document FROM chunks WHERE NOT (collection_name = 'default' AND id IN (SELECT 'doc' || doc_id FROM documents)) UNION ALL SELECT 'default', 'doc' || doc_id, text FROM documents",
    "q_manifest_diff": f"WITH {STATUS} SELECT source, mtime, status FROM status",
    "q_ingest_counters": f"WITH {STATUS} SELECT status, count(*) AS files FROM status GROUP BY status",
    "q_manifest_roundtrip": "SELECT source, max(mtime) AS mtime FROM (SELECT source, mtime FROM manifest UNION ALL SELECT source, mtime FROM raw_files) WHERE source IS NOT NULL GROUP BY source",
    "q_boilerplate": f"SELECT heading, {has(strip(sub('heading', P.EMPHASIS)), P.BOILERPLATE)} AS flag FROM (SELECT DISTINCT coalesce(heading, '') AS heading FROM chunks)",
    "q_heading_lines": HEADED + f" SELECT id, pos, line, {sub('t', P.ATX_MARK)} AS heading FROM hl WHERE h",
    "q_prose_words": f"WITH {DOCS}, {noise('docs', 'document', 'id')} SELECT id, prose AS n FROM judged",
    "q_table_dominated": f"WITH {DOCS}, {noise('docs', 'document', 'id')} SELECT id, tables AS flag FROM judged",
    "q_toc_dominated": f"WITH {DOCS}, {noise('docs', 'document', 'id')} SELECT id, toc AS flag FROM judged",
    "q_url_dominated": f"WITH {DOCS}, {noise('docs', 'document', 'id')} SELECT id, urls AS flag FROM judged",
    "q_meaningful": f"WITH {DOCS}, {noise('docs', 'document', 'id')} SELECT id, NOT tables AND NOT toc AND NOT urls AND enough AS flag FROM judged",
    "q_placeholder_meta": f"SELECT DISTINCT title, author, {real('title', P.PLACEHOLDER_TITLE)} AS real_title, {real('author', P.PLACEHOLDER_AUTHOR)} AS real_author FROM chunks",
    "q_file_metadata": f"WITH {FILES} SELECT source, {filename('source')} AS filename, {stem('source')} AS stem, {suffix('source')} AS suffix, mtime, {stem('source')} AS title, '' AS author, 0 AS page_count, '' AS creation_date FROM once",
    "q_title_fallback": f"WITH d AS (SELECT DISTINCT source, title, author, {stem('source')} AS s FROM chunks) SELECT source, title, author, {first_of(real('title', P.PLACEHOLDER_TITLE), names('s', 1), 's')} AS shown_title, {first_of(real('author', P.PLACEHOLDER_AUTHOR), names('s', 2))} AS shown_author FROM d",
    "q_pdf_date": "SELECT creation_date, CASE WHEN regexp_matches(d, '^[0-9]{8}') THEN d[1:4] || '-' || d[5:6] || '-' || d[7:8] ELSE '' END AS date FROM (SELECT DISTINCT creation_date, replace(creation_date, '-', '') || '120000Z' AS d FROM chunks)",
    "q_filename_parse": f"WITH d AS (SELECT DISTINCT source, title, author FROM chunks), s AS (SELECT source, title, {STEM_PARTS} AS stem FROM d) SELECT source, title, stem, {names('stem', 1)} AS parsed_title, {names('stem', 2)} AS parsed_author FROM s",
    "q_lines": f"WITH {DOCS}, {lines_of()} SELECT d.id, count(line)::INT AS n, coalesce(string_agg(line, chr(10) ORDER BY pos), '') AS text FROM docs d LEFT JOIN ln USING (id) GROUP BY d.id",
    "q_sections": SECTIONS + " SELECT s.id, section_no, heading, count(*)::INT AS n, string_agg(line, chr(10) ORDER BY k) AS text FROM sections s JOIN body b ON s.id = b.id AND s.sec = b.sec GROUP BY 1, 2, 3",
    "q_sections_kept": SECTIONS + f" SELECT id, section_no, heading FROM sections WHERE NOT {has(strip(sub('heading', P.EMPHASIS)), P.BOILERPLATE)}",
    "q_heading_norm": SECTIONS + f" SELECT DISTINCT heading, {strip(sub('heading', P.HEADING_PAGE))} AS name FROM sections",
    "q_code_runs": CODE + " SELECT f.id, section_no, text FROM fenced f JOIN sections s ON f.id = s.id AND f.sec = s.sec",
    "q_paragraphs": PARAGRAPHS + " SELECT p.id, section_no, place, paragraph FROM pars p JOIN sections s ON p.id = s.id AND p.sec = s.sec",
    "q_sentences": SENTENCES + " SELECT p.id, section_no, k - 1 AS place, sentence FROM sents p JOIN sections s ON p.id = s.id AND p.sec = s.sec",
    "q_chunk_fold": fold(60) + " SELECT r.id, section_no, chunk_no, first, last FROM numbered r JOIN sections s ON r.id = s.id AND r.sec = s.sec",
    "q_orphan_merge": merged(60) + " SELECT f.id, section_no, chunk_no, chunk FROM final f JOIN sections s ON f.id = s.id AND f.sec = s.sec",
    "q_orphans_made": merged(60).replace(DOCS, "docs AS (SELECT DISTINCT id, replace(document, '. The ', '. Therefore, the ') AS document FROM chunks)") + " SELECT f.id, section_no, chunk_no, chunk FROM final f JOIN sections s ON f.id = s.id AND f.sec = s.sec",
    "q_noise_made": f"WITH kinds AS (SELECT source, coalesce(max(length % 4), 0)::INT AS k FROM raw_files GROUP BY source), made AS (SELECT source AS id, repeat('1.2 ' || source[1:40] || ' ....... 17' || chr(10), k) || repeat('https://example.org/' || replace(source, ' ', '_') || chr(10), 3 - k) || 'One line of text.' || chr(10) AS document FROM kinds), {noise('made', 'document', 'id')} SELECT id AS source, toc, urls, NOT tables AND NOT toc AND NOT urls AND enough AS keep FROM judged",
    "q_smart_chunk": chunks_sql(500) + " SELECT id, section_no, chunk_no, heading, body FROM smart",
    "q_chunks_per_doc": chunks_sql(500) + " SELECT id, count(*) AS chunks FROM smart GROUP BY id",
    "q_chunk_ids": chunks_sql(500) + " SELECT id AS doc, row_number() OVER w - 1 AS chunk_index, id || '__ch' || (row_number() OVER w - 1) AS id FROM smart WINDOW w AS (PARTITION BY id ORDER BY section_no, chunk_no)",
    "q_line_freq": f"WITH {DOCS}, {lines_of()}, s AS (SELECT id, {strip('line')} AS line FROM ln) SELECT id, line, count(*) AS n FROM s WHERE line <> '' AND length(line) < 72 AND NOT {has('line', P.NUMBERED_CODE)} GROUP BY 1, 2",
    "q_chunks_per_source": f"WITH {PER_SOURCE} SELECT source, chunks FROM per_source",
    "q_completeness": REPORT + " SELECT source, name, extracted, chunks, issues FROM report",
    "q_completeness_totals": REPORT + " SELECT count(*) AS files, sum(chunks)::BIGINT AS chunks, count(*) FILTER (issues <> 'OK') AS with_issues FROM report",
    "q_orphan_sources": f"WITH {PER_SOURCE}, {ORPHANS} SELECT source, chunks FROM orphans",
    "q_check_verdict": REPORT + f", {ORPHANS}, o AS (SELECT count(*) AS orphans FROM orphans), r AS (SELECT count(*) AS files, count(*) FILTER (issues = 'OK') AS complete FROM report) SELECT files, complete, orphans, files > 0 AND files = complete AND orphans = 0 AS ok FROM r, o",
    "q_entities": ENTITIES + " SELECT id, row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS place, entity FROM firsts",
    "q_graph_from_text": ENTITIES + " SELECT entity, count(DISTINCT id) AS chunks FROM firsts GROUP BY entity",
    "q_graph_nodes": f"WITH {LINKS} SELECT entity, chunk FROM links",
    "q_graph_edges": f"WITH {LINKS} SELECT x.entity AS a, y.entity AS b, count(*) AS weight FROM links x JOIN links y ON x.chunk = y.chunk AND x.entity < y.entity GROUP BY 1, 2",
    "q_graph_update": f"WITH {GRAPH} SELECT a, b, weight FROM graph",
    "q_graph_stats": f"WITH {LINKS}, {GRAPH} SELECT (SELECT count(DISTINCT entity) FROM links) AS nodes, (SELECT count(*) FROM graph) AS edges",
    "q_graph_json": f"WITH {LINKS}, {GRAPH} SELECT json_object('kind', 'node', 'id', entity, 'chunk', chunk)::VARCHAR AS line FROM links UNION ALL SELECT json_object('kind', 'edge', 'source', a, 'target', b, 'weight', weight)::VARCHAR FROM graph",
    "q_graph_topk": f"WITH {GRAPH} SELECT node, neighbour, weight, rank FROM ranked WHERE rank <= 3",
    "q_graph_expand": f"WITH {expand(2)} SELECT concept, score, rank FROM expanded",
    "q_graph_expand_1hop": f"WITH {expand(1)} SELECT concept, score, rank FROM expanded",
    "q_concept_map": f"""WITH {GRAPH}, {ASKED_SQL}, hop1 AS (SELECT r.*, place FROM ranked r JOIN asked USING (node) WHERE rank <= 8),
keys AS (SELECT node AS concept, place * 10 AS p, 8 AS width FROM hop1 UNION ALL SELECT neighbour, place * 10 + rank, 5 FROM hop1 WHERE rank <= 3),
named AS (SELECT concept, min(p) AS p, max(width) AS width FROM keys GROUP BY concept), placed AS (SELECT *, row_number() OVER (ORDER BY p, concept) AS place FROM named)
SELECT concept, place, neighbour, rank FROM placed JOIN ranked ON concept = node WHERE rank <= width""",
    "q_vector_topk": f"WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 0), d AS (SELECT vec_id, {DISTANCE.format(a='embedding', b='e')} AS distance FROM embeddings, q), t AS (SELECT * FROM d ORDER BY distance, vec_id LIMIT 5) SELECT row_number() OVER (ORDER BY distance, vec_id) AS rank, vec_id, distance FROM t",
    "q_vector_topk_label": f"WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 0), d AS (SELECT vec_id, {DISTANCE.format(a='embedding', b='e')} AS distance FROM embeddings, q WHERE label % 2 = 1), t AS (SELECT * FROM d ORDER BY distance, vec_id LIMIT 10) SELECT row_number() OVER (ORDER BY distance, vec_id) AS rank, vec_id, distance FROM t",
    "q_vector_knn_batch": f"WITH d AS (SELECT q.vec_id AS query, v.vec_id, {DISTANCE.format(a='v.embedding', b='q.embedding')} AS distance FROM embeddings v, embeddings q WHERE q.vec_id % 100 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, vec_id) AS rank FROM d) SELECT query, rank, vec_id, distance FROM r WHERE rank <= 5",
    "q_search_text": f"WITH {DOCS}, " + search("SELECT unnest([" + ", ".join(lit(w) for w in query_words(QUERY)) + "]) AS word"),
    "q_search_graph": f"WITH {DOCS}, {expand(2)}, " + search(f"SELECT unnest(regexp_extract_all({lit(' '.join(query_words(QUERY)))} || ' ' || (SELECT string_agg({ASCII_LOWER.format('concept')}, ' ') FROM expanded), '[a-z0-9]+')) AS word"),
}
