"""Lines, sentences, chunks, keywords."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import taxonomy as X
from ..functions import text as T
from ..functions.fixed_values import KNOWN_SECTIONS
from ..operators import chunking as C
from ..operators import flat_text as P
from ..operators import tagging as G
from ..sources.tables import spread, table
from .registry import Registry, tokens, words

R = Registry()

_LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents"


def _documents(spark, sf_dir):
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _pages(spark, sf_dir):
    return _documents(spark, sf_dir).withColumn("page", F.lit(1))


@R.add(
    rf"""SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, regexp_replace(line, '^\s+|\s+$', '', 'g') AS line FROM ({_LINES}))
WHERE line <> '' GROUP BY ALL HAVING count(*) >= 3 AND {words("line")} <= 10"""
)
def line_boilerplate(spark, sf_dir):
    return P.repeated_lines(P.page_lines(_pages(spark, sf_dir)))


@R.add(
    rf"""WITH l AS (SELECT doc_id, regexp_replace(line, '^\s+|\s+$', '', 'g') AS line FROM ({_LINES})),
b AS (SELECT doc_id, line FROM l WHERE line <> '' GROUP BY ALL HAVING count(*) >= 3 AND {words("line")} <= 10)
SELECT l.doc_id, count(*) AS n_lines FROM l ANTI JOIN b ON l.doc_id = b.doc_id AND l.line = b.line WHERE length(line) >= 3 GROUP BY 1"""
)
def lines_kept(spark, sf_dir):
    lines = P.page_lines(_pages(spark, sf_dir))
    common = P.repeated_lines(lines).select("doc_id", "line")
    return lines.where(F.length("line") >= 3).join(common, ["doc_id", "line"], "left_anti").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))


@R.add(
    r"""SELECT doc_id, zone, signature, count(DISTINCT page) AS pages FROM (
  SELECT o_custkey AS doc_id, o_orderstatus AS zone, regexp_replace(regexp_replace(lower('file2 ' || o_orderpriority || ' ' || o_orderkey), '^\d{1,4}\s+', '<page> '), '\s+\d{1,4}$', ' <page>') AS signature, o_orderkey AS page FROM orders)
GROUP BY ALL HAVING count(DISTINCT page) >= 3"""
)
def margin_repeats(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    text = F.concat_ws(" ", F.lit("\ufb01le\u00b2"), "o_orderpriority", F.col("o_orderkey").cast("string"))
    return P.repeated_margins(o.select(F.col("o_custkey").alias("doc_id"), F.col("o_orderstatus").alias("zone"), T.margin_signature(text).alias("signature"), F.col("o_orderkey").alias("page")))


_HEADS = """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN (p_partkey % 9 + 1) || '.' || p_size || ' ' || p_name WHEN 1 THEN p_size || '. ' || p_name || ' ..... 12'
  WHEN 2 THEN p_name || ' – ' || p_type WHEN 3 THEN upper(p_name) ELSE p_size || ' fi2 ' || p_name END AS head FROM part"""


@R.add(
    rf"""WITH h AS ({_HEADS}), k AS (SELECT p_partkey, head, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(head)), '\.{{3,}}\s*\d{{1,4}}\s*$', ''), '[–—-]', ' ', 'g'), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'), '\s+', ' ', 'g')) AS key FROM h)
SELECT p_partkey, key, regexp_replace(key, '^\d{{1,3}}(?:\s+\d{{1,3}})*\s+', '') AS bare,
  CASE WHEN regexp_matches(head, '^\d{{1,3}}(?:\.\d{{1,3}})*\.?\s+\S') THEN CAST(len(string_split(regexp_extract(head, '^(\d{{1,3}}(?:\.\d{{1,3}})*)\.?\s+\S', 1), '.')) AS INTEGER) END AS depth,
  regexp_extract(head, '^(\d{{1,3}}(?:\.\d{{1,3}})*)\.?\s+', 1) AS prefix FROM k"""
)
def heading_keys(spark, sf_dir):
    p, n, s = F.col("p_partkey"), F.col("p_name"), F.col("p_size").cast("string")
    head = (
        F.when(p % 5 == 0, F.concat((p % 9 + 1).cast("string"), F.lit("."), s, F.lit(" "), n))
        .when(p % 5 == 1, F.concat(s, F.lit(". "), n, F.lit(" ..... 12")))
        .when(p % 5 == 2, F.concat(n, F.lit(" – "), F.col("p_type")))
        .when(p % 5 == 3, F.upper(n))
        .otherwise(F.concat(s, F.lit(" \ufb01\u00b2 "), n))
    )
    rows = table(spark, sf_dir, "part").select("p_partkey", head.alias("h"))
    h = F.col("h")
    return rows.select(
        "p_partkey",
        T.heading_key(h).alias("key"),
        T.heading_key_without_number(h).alias("bare"),
        T.numeric_depth(h).alias("depth"),
        T.numeric_prefix(h).alias("prefix"),
    )


_SENTENCES = r"""SELECT doc_id, unnest(list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+([A-Z])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '')) AS sentence FROM documents"""


@R.add(f"SELECT doc_id, count(*) AS n, CAST(max(length(sentence)) AS INTEGER) AS longest, CAST(sum({words('sentence')}) AS BIGINT) AS words FROM ({_SENTENCES}) GROUP BY 1")
def sentence_split(spark, sf_dir):
    s = _documents(spark, sf_dir).select("doc_id", F.explode(T.sentences(F.col("text"))).alias("sentence"))
    return s.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("sentence")).alias("longest"), F.sum(T.word_count(F.col("sentence"))).alias("words"))


_PACK = rf"""
WITH RECURSIVE u AS (
  SELECT doc_id, tok, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rn FROM (SELECT doc_id, i, {tokens("line")} AS tok FROM ({_LINES}) WHERE trim(line) <> '')
), g AS (
  SELECT doc_id, rn, tok, 1 AS grp, tok AS run FROM u WHERE rn = 1
  UNION ALL
  SELECT u.doc_id, u.rn, u.tok, CASE WHEN g.run + u.tok > 800 THEN g.grp + 1 ELSE g.grp END, CASE WHEN g.run + u.tok > 800 THEN u.tok ELSE g.run + u.tok END
  FROM g JOIN u ON u.doc_id = g.doc_id AND u.rn = g.rn + 1
)"""


@R.add(_PACK + " SELECT doc_id, CAST(grp AS INTEGER) AS grp, count(*) AS units, CAST(sum(tok) AS BIGINT) AS tokens FROM g GROUP BY 1, 2")
def greedy_pack(spark, sf_dir):
    """Lines packed to 800 tokens; one array fold a document. Lines of spaces of any kind don't count."""
    sized = C.units(F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\p{Zs}]")))
    groups = _documents(spark, sf_dir).select("doc_id", F.posexplode(C.greedy_pack(sized, 800)).alias("i", "own"))
    total = F.aggregate("own", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    return groups.select("doc_id", (F.col("i") + 1).alias("grp"), F.size("own").cast("long").alias("units"), total.alias("tokens"))


_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_HEAD = (
    f"(l <> '' AND length(l) <= 120 AND (regexp_matches(l, '^#{{1,6}}\\s+\\S') OR regexp_matches(l, '^[A-Z](?:[A-Z\\s\\d:\\-]{{3,}}|[A-Z\\s\\d:\\-]{{2}})$')"
    " OR regexp_matches(l, '^\\d+(?:\\.\\d+)*[.)]\\s+\\S')))"
)


def _label(title: str, part: str, total: str, more: str) -> str:
    name = f"'[Section: ' || CASE WHEN coalesce({title}, '') = '' THEN 'Preamble' ELSE {title} END"
    return f"{name} || CASE WHEN {total} = 1 THEN ']' ELSE ' — Part ' || {part} || ' of ' || {total} || CASE WHEN {more} THEN ', Paragraph continued' ELSE '' END || ']' END"


# lines to sections; sections whole, or as packed paragraphs, or as packed sentences; runs of whole small sections merged
_CHUNKS = rf"""
WITH RECURSIVE lines AS (
  SELECT doc_id, unnest(cut) AS line, unnest(range(len(cut))) AS i
  FROM (SELECT doc_id, regexp_split_to_array(text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]') AS cut FROM documents WHERE regexp_matches(text, '\S'))
), marked AS (
  SELECT *, sum(CAST(h AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS sec FROM (SELECT *, {_HEAD} AS h FROM (SELECT *, {_STRIP.format("line")} AS l FROM lines))
), secs AS (
  SELECT doc_id, sec, max(CASE WHEN h THEN l END) AS heading, {_STRIP.format("coalesce(string_agg(CASE WHEN NOT h THEN line END, chr(10) ORDER BY i), '')")} AS body FROM marked GROUP BY 1, 2
), sized AS (
  SELECT *, {tokens("t")} AS n FROM (SELECT *, concat_ws(chr(10), heading, body) AS t FROM secs WHERE heading IS NOT NULL OR body <> '')
), paras AS (
  SELECT doc_id, sec, heading, n, i, p, {tokens("p")} AS tok FROM (
    SELECT doc_id, sec, heading, n, unnest(ps) AS p, unnest(range(len(ps))) AS i
    FROM (SELECT *, list_filter(list_transform(regexp_split_to_array(body, '\n\s*\n'), lambda x: {_STRIP.format("x")}), lambda x: x <> '') AS ps FROM sized WHERE n > 800))
), tiered AS (
  SELECT *, CASE WHEN max(tok) OVER (PARTITION BY doc_id, sec) <= 800 THEN 2 ELSE 3 END AS tier FROM paras
), pieces AS (
  SELECT doc_id, sec, heading, n, tier, i, 0 AS j, p AS u, tok FROM tiered WHERE tok <= 800
  UNION ALL
  SELECT doc_id, sec, heading, n, tier, i, j, u, {tokens("u")} FROM (
    SELECT doc_id, sec, heading, n, tier, i, unnest(ss) AS u, unnest(range(len(ss))) AS j FROM (
      SELECT *, list_filter(list_transform(string_split(regexp_replace(p, '([.!?])\s+([A-Z])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda x: {_STRIP.format("x")}), lambda x: x <> '') AS ss FROM tiered WHERE tok > 800))
), turned AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, sec ORDER BY i, j) AS rn FROM pieces
), run AS (
  SELECT doc_id, sec, rn, tok AS held, 1 AS part FROM turned WHERE rn = 1
  UNION ALL
  SELECT t.doc_id, t.sec, t.rn, CASE WHEN r.held + t.tok > 800 THEN t.tok ELSE r.held + t.tok END, CASE WHEN r.held + t.tok > 800 THEN r.part + 1 ELSE r.part END
  FROM run r JOIN turned t ON t.doc_id = r.doc_id AND t.sec = r.sec AND t.rn = r.rn + 1
), parts AS (
  SELECT t.doc_id, t.sec, any_value(heading) AS heading, any_value(n) AS n, any_value(tier) AS tier, part, count(*) AS units,
         CASE WHEN any_value(tier) = 2 THEN string_agg(u, chr(10) || chr(10) ORDER BY rn) ELSE string_agg(u, ' ' ORDER BY rn) END AS joined
  FROM (SELECT t.*, r.part FROM turned t JOIN run r USING (doc_id, sec, rn)) t GROUP BY t.doc_id, t.sec, part
), split AS (
  SELECT *, max(part) OVER (PARTITION BY doc_id, sec) AS total FROM parts
), raw AS (
  SELECT doc_id, sec, 1 AS part, 1 AS total, 1 AS tier, heading AS title, {_label("heading", "1", "1", "FALSE")} AS label, {_label("heading", "1", "1", "FALSE")} || chr(10) || t AS text, n AS token_count,
         'Tier 1 — section fits (' || n || ' <= 800 tokens)' AS reason FROM sized WHERE n <= 800
  UNION ALL
  SELECT doc_id, sec, part, total, tier, heading, label, text, {tokens("text")}, CASE WHEN tier = 2 THEN 'Tier 2 — section too large (' || n || ' tokens); packed ' || units || ' paragraph(s) into part ' || part || '/' || total
         ELSE 'Tier 3 — paragraph(s) too large even after section split; sentence-packed part ' || part || '/' || total END
  FROM (SELECT *, label || chr(10) || joined AS text FROM (SELECT *, {_label("heading", "part", "total", "tier = 3 AND part > 1")} AS label FROM split))
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sec, part) AS rn FROM raw
), merging AS (
  SELECT doc_id, rn, tier, token_count AS held, 1 AS g FROM numbered WHERE rn = 1
  UNION ALL
  SELECT c.doc_id, c.rn, c.tier, CASE WHEN m.tier <> 1 OR c.tier <> 1 OR m.held + c.token_count > 800 THEN c.token_count ELSE m.held + c.token_count END,
         CASE WHEN m.tier <> 1 OR c.tier <> 1 OR m.held + c.token_count > 800 THEN m.g + 1 ELSE m.g END
  FROM merging m JOIN numbered c ON c.doc_id = m.doc_id AND c.rn = m.rn + 1
), merged AS (
  SELECT doc_id, g, count(*) AS k, CAST(sum(token_count) AS INTEGER) AS token_count, max(tier) AS tier, first(title ORDER BY rn) AS title, first(label ORDER BY rn) AS label, first(text ORDER BY rn) AS text,
         max(part) AS part, max(total) AS total, first(reason ORDER BY rn) AS reason, string_agg(nullif(title, ''), ' | ' ORDER BY rn) AS titles, string_agg(text, chr(10) || chr(10) ORDER BY rn) AS texts, string_agg(CAST(token_count AS VARCHAR), ', ' ORDER BY rn) AS counts
  FROM (SELECT n.*, m.g FROM numbered n JOIN merging m USING (doc_id, rn)) GROUP BY 1, 2
), chunks AS (
  SELECT doc_id, CAST(g - 1 AS INTEGER) AS index, CASE WHEN k = 1 THEN text ELSE l || chr(10) || chr(10) || texts END AS text, token_count, CAST(tier AS INTEGER) AS tier, title AS section_title, CASE WHEN k = 1 THEN label ELSE l END AS part_label,
         k = 1 AND part > 1 AS is_continuation, CAST(CASE WHEN k = 1 THEN part ELSE 1 END AS INTEGER) AS parent_section_part, CAST(CASE WHEN k = 1 THEN total ELSE 1 END AS INTEGER) AS parent_section_total,
         CASE WHEN k = 1 THEN reason ELSE 'Tier 1 merge — ' || k || ' small sections combined (' || counts || ' tokens)' END AS tier_reason
  FROM (SELECT *, CASE WHEN titles IS NULL THEN '[Document Preamble]' ELSE '[Sections: ' || titles || ']' END AS l FROM merged)
)"""


@R.add(_CHUNKS + " SELECT * FROM chunks")
def chunk_rhetorical(spark, sf_dir):
    return C.chunk_documents(_documents(spark, sf_dir))


@R.add(
    _CHUNKS
    + """ SELECT doc_id, count(*) AS n_chunks, count(*) FILTER (tier = 1) AS tier_1, count(*) FILTER (tier = 2) AS tier_2, count(*) FILTER (tier = 3) AS tier_3, min(token_count) AS min_tokens, max(token_count) AS max_tokens,
  CAST(floor(avg(token_count)) AS INTEGER) AS avg_tokens, coalesce(string_agg(CASE WHEN token_count > 800 THEN index + 1 END, ',' ORDER BY index), '') AS over_threshold, coalesce(string_agg(CASE WHEN token_count < 50 THEN index + 1 END, ',' ORDER BY index), '') AS tiny
FROM chunks GROUP BY 1"""
)
def chunk_report(spark, sf_dir):
    joined = {c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",") for c in ("over_threshold", "tiny")}
    return C.chunk_report(C.chunk_documents(_documents(spark, sf_dir))).withColumns(joined)


# lines cut at merged headings, without running heads; headings once a document; runs of short headings are lists; small sections joined
_FLAT = rf"""
WITH l0 AS (SELECT doc_id, i, {_STRIP.format("line")} AS line FROM ({_LINES})),
common AS (SELECT doc_id, line FROM l0 WHERE line <> '' GROUP BY ALL HAVING count(*) >= 3 AND {words("line")} <= 10),
starts AS (SELECT *, len(regexp_extract_all(line, '\d{{1,2}}\.\s+[A-Z]')) AS n, regexp_matches(line, '^\d{{1,2}}\.\s+[A-Z]') AS lead, list_filter(regexp_split_to_array(line, '\s+'), lambda x: x <> '') AS w FROM l0),
cut AS (
  SELECT doc_id, i, unnest(own) AS line, unnest(range(len(own))) AS part FROM (SELECT doc_id, i, CASE
    WHEN n >= 2 THEN list_filter(list_transform(string_split(regexp_replace(line, '\b(\d{{1,2}}\.\s+[A-Z])', chr(1) || '\1', 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')
    WHEN n = 1 AND lead AND len(w) > 12 THEN [array_to_string(w[1:12], ' '), array_to_string(w[13:], ' ')] ELSE [line] END AS own FROM starts)
), kept AS (
  SELECT c.doc_id, i, part, regexp_replace(c.line, '-\s+', '', 'g') AS line FROM cut c ANTI JOIN common b ON b.doc_id = c.doc_id AND b.line = c.line
  WHERE length(c.line) >= 3 AND NOT regexp_matches(c.line, '^\d{{1,4}}$|^\d{{1,3}}\s+\d{{1,3}}$')
), heads AS (
  SELECT *, {words("line")} AS n, regexp_matches(line, '^\d{{1,2}}(\.\d{{1,2}})*\.\s+[A-Z][a-z].{{1,80}}$') OR regexp_matches(line, '^[A-Z][A-Z\s]{{3,40}}:?$') AS strong, regexp_matches(line, '\d+\.\s+\w.+\d+\.\s+\w') AS two FROM kept
), flagged AS (
  SELECT *, CASE WHEN strong THEN n <= 15 AND NOT two ELSE n <= 8 AND NOT two AND NOT (regexp_matches(line, '^\d{{1,2}}\s+[A-Z]') AND n > 2) AND NOT regexp_matches(line, '[,;]$|,\s+\w')
    AND NOT (regexp_matches(line, '^(Our|This|They|We|It|In|On|By|For|As|At)\s+\w') AND n > 2) AND lower(line) IN ({", ".join(f"'{x}'" for x in KNOWN_SECTIONS)}) END AS head FROM heads
), once AS (
  SELECT *, head AND row_number() OVER (PARTITION BY doc_id, line, head ORDER BY i, part) = 1 AS is_heading, row_number() OVER (PARTITION BY doc_id ORDER BY i, part) AS pos FROM flagged
), turns AS (
  SELECT *, sum(turn) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM (SELECT *, CAST(coalesce(lag(is_heading) OVER (PARTITION BY doc_id ORDER BY pos), FALSE) <> is_heading AS INTEGER) AS turn FROM once)
), tagged AS (
  SELECT doc_id, pos, line, is_heading AND NOT (count(*) OVER (PARTITION BY doc_id, run) > 1 AND max(n) OVER (PARTITION BY doc_id, run) <= 4) AS h FROM turns
), parted AS (
  SELECT doc_id, part, max(CASE WHEN h THEN line END) AS heading, trim(regexp_replace(coalesce(string_agg(CASE WHEN NOT h THEN line END, ' ' ORDER BY pos), ''), '[\s\x{{a0}}]+', ' ', 'g')) AS content
  FROM (SELECT *, sum(CAST(h AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY pos) AS part FROM tagged) GROUP BY 1, 2
), stands AS (
  SELECT *, sum(CAST(first AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY part) AS section_no
  FROM (SELECT *, {words("content")} >= 15 OR row_number() OVER (PARTITION BY doc_id ORDER BY part) = 1 AS first FROM parted WHERE content <> '')
), out AS (
  SELECT doc_id, section_no, coalesce(max(CASE WHEN first THEN heading END), '') AS heading, trim(regexp_replace(string_agg(CASE WHEN first THEN content ELSE concat_ws(' ', heading, content) END, ' ' ORDER BY part), '\s+', ' ', 'g')) AS content FROM stands GROUP BY 1, 2
)
SELECT doc_id, CAST(section_no AS BIGINT) AS section_no, heading, content, {words("content")} AS word_count, CAST(length(content) AS INTEGER) AS char_count, {tokens("content")} AS token_count FROM out"""


@R.add(_FLAT)
def flat_sections(spark, sf_dir):
    return P.flat_sections(_pages(spark, sf_dir))


def _assembled(spark, sf_dir):
    """Each conversation as a resource: system turns as its own text, users' as pages, answers as files."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    of = lambda role: F.transform(F.filter("t", lambda x: x["role"] == role), lambda x: F.struct(x["turn"].cast("string").alias("title"), x["text"].alias("text")))
    parent = F.array_join(F.transform(of("system"), lambda x: x["text"]), "\n\n")
    return turns.select("conv_id", C.assemble(parent, of("user"), of("assistant")).alias("text"))


def _linked(role: str, kind: str) -> str:
    """SQL of the listed items of a role, each behind its own line."""
    return f"""SELECT conv_id, string_agg(chr(10) || '--- Linked {kind} ' || k || ': ' || turn || ' ---' || chr(10) || chr(10) || coalesce(text, ''), chr(10) || chr(10) ORDER BY k) AS t
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM conversations WHERE role = '{role}') GROUP BY 1"""


_MARKED = f"""sections AS (
  SELECT conv_id, label, {_STRIP.format("t")} AS text, part FROM (
    SELECT conv_id, 'PARENT CONTENT' AS label, 1 AS part, string_agg(text, chr(10) || chr(10) ORDER BY turn, text) AS t FROM conversations WHERE role = 'system' GROUP BY 1
    UNION ALL SELECT conv_id, 'LINKED WEB PAGES', 2, t FROM ({_linked("user", "page")})
    UNION ALL SELECT conv_id, 'LINKED PDFs', 3, t FROM ({_linked("assistant", "PDF")}))
  WHERE {_STRIP.format("t")} <> ''
)"""
_JOINED = "array_to_string(list_transform({0}, lambda x: x.text), chr(10) || chr(10))"
# the last paragraphs, up to 60 tokens, of a chunk open the next one as one paragraph
_OVERLAPS = f"""
WITH RECURSIVE {_MARKED}, paras AS (
  SELECT conv_id, part, row_number() OVER (PARTITION BY conv_id, part ORDER BY i) AS rn, p AS text, {tokens("p")} AS tok
  FROM (SELECT conv_id, part, unnest(ps) AS p, unnest(range(len(ps))) AS i FROM (SELECT conv_id, part, string_split(text, chr(10) || chr(10)) AS ps FROM sections WHERE {tokens("text")} > 300)) WHERE regexp_matches(p, '\\S')
), fold AS (
  SELECT conv_id, part, rn, [{{'text': text, 'tok': tok}}] AS open, tok AS held, 0 AS over, CAST(NULL AS VARCHAR) AS said, CAST(NULL AS INTEGER) AS n, CAST(NULL AS INTEGER) AS o FROM paras WHERE rn = 1
  UNION ALL
  SELECT conv_id, part, rn, CASE WHEN NOT full_ THEN list_append(open, {{'text': text, 'tok': tok}}) WHEN {_JOINED.format("kept")} <> '' THEN [{{'text': {_JOINED.format("kept")}, 'tok': tail}}, {{'text': text, 'tok': tok}}] ELSE [{{'text': text, 'tok': tok}}] END,
    CASE WHEN NOT full_ THEN held + tok WHEN {_JOINED.format("kept")} <> '' THEN tail + tok ELSE tok END, CASE WHEN NOT full_ THEN over WHEN {_JOINED.format("kept")} <> '' THEN tail ELSE 0 END,
    CASE WHEN full_ THEN {_JOINED.format("open")} END, CASE WHEN full_ THEN held END, CASE WHEN full_ THEN over END
  FROM (SELECT *, CAST(coalesce(list_sum(list_transform(kept, lambda x: x.tok)), 0) AS INTEGER) AS tail FROM (
    SELECT f.conv_id, f.part, p.rn, p.text, p.tok, f.open, f.held, f.over, f.held + p.tok > 300 AS full_,
      f.open[1 + len(list_filter(range(1, len(f.open) + 1), lambda i: list_sum(list_transform(f.open[i:], lambda x: x.tok)) > 60)):] AS kept
    FROM fold f JOIN paras p ON p.conv_id = f.conv_id AND p.part = f.part AND p.rn = f.rn + 1))
), said AS (
  SELECT conv_id, part, rn, 0 AS z, said AS text, n AS token_count, o AS overlap_tokens FROM fold WHERE said IS NOT NULL
  UNION ALL SELECT conv_id, part, rn, 1, {_JOINED.format("open")}, held, over FROM (SELECT *, max(rn) OVER (PARTITION BY conv_id, part) AS last FROM fold) WHERE rn = last
  UNION ALL SELECT conv_id, part, 0, 0, text, {tokens("text")}, 0 FROM sections WHERE {tokens("text")} <= 300
)
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY part, rn, z) AS INTEGER) AS chunk_index, label AS section, s.text, CAST(token_count AS INTEGER) AS token_count, CAST(overlap_tokens AS INTEGER) AS overlap_tokens
FROM said s JOIN (SELECT conv_id, part, label FROM sections) USING (conv_id, part)"""


@R.add(_OVERLAPS)
def overlap_chunks(spark, sf_dir):
    out = _assembled(spark, sf_dir).select("conv_id", F.posexplode(C.chunk_structured(F.col("text"), 300, 60)).alias("i", "c"))
    return out.select("conv_id", (F.col("i") + 1).alias("chunk_index"), "c.*")


@R.add(f"WITH {_MARKED} SELECT conv_id, label, text FROM sections")
def section_markers(spark, sf_dir):
    s = _assembled(spark, sf_dir).select("conv_id", F.explode(C.marker_sections(F.col("text"))).alias("s"))
    return s.select("conv_id", "s.label", "s.text")


_CONT = f"""
WITH c AS (SELECT conv_id AS doc_id, turn, role, {tokens("text")} AS tok, text, role = 'assistant' AS cont FROM conversations),
g AS (SELECT *, sum(CASE WHEN NOT cont OR turn = first THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY turn) AS group_no
  FROM (SELECT *, min(turn) OVER (PARTITION BY doc_id) AS first FROM c))"""


@R.add(
    _CONT
    + """ SELECT doc_id, CAST(group_no AS BIGINT) AS group_no, list(turn ORDER BY turn) AS chunk_numbers, string_agg(role, ' + ' ORDER BY turn) AS part_label,
  count(*) > 1 AS is_merged, CAST(sum(tok) AS BIGINT) AS token_count, md5(string_agg(text, chr(10) || chr(10) ORDER BY turn)) AS text_md5 FROM g GROUP BY 1, 2"""
)
def continuation_groups(spark, sf_dir):
    chunks = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"),
        F.col("turn").alias("chunk_number"),
        F.col("role").alias("part_label"),
        T.approx_tokens(F.col("text")).alias("token_count"),
        "text",
        (F.col("role") == "assistant").alias("is_continuation"),
    )
    return C.continuation_groups(chunks).withColumn("text_md5", F.md5("text")).drop("text")


@R.add(
    f"""WITH s AS (SELECT conv_id AS resource_id, turn AS pos, {tokens("text")} AS tokens FROM conversations),
r AS (SELECT *, sum(tokens) OVER (PARTITION BY resource_id) - coalesce(sum(tokens) OVER (PARTITION BY resource_id ORDER BY tokens, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over FROM s)
SELECT resource_id, pos, tokens FROM r WHERE left_over <= 900"""
)
def reduce_budget(spark, sf_dir):
    s = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("resource_id"), F.col("turn").alias("pos"), T.approx_tokens(F.col("text")).alias("tokens"))
    return G.reduce_budget(s, 900)


def _phrases(column: str, phrases: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{p}')" for p in phrases) + ")"


_PHRASES = "(SELECT p_partkey, p_name || ' ' || CASE p_partkey % 6 WHEN 0 THEN 'was PILOTED at' WHEN 1 THEN 'for various groups' WHEN 2 THEN 'a grant award' WHEN 3 THEN 'pre-award and cohort' ELSE p_type END AS t FROM part)"


@R.add(
    f"""SELECT p_partkey, {_phrases("t", X.GENERIC_PHRASES)} AS generic, {_phrases("t", X.FUNDING_KEYWORDS)} AS funding, {_phrases("t", X.IMPLEMENTATION_KEYWORDS)} AS used FROM {_PHRASES}"""
)
def keyword_flags(spark, sf_dir):
    p = F.col("p_partkey")
    tail = F.when(p % 6 == 0, "was PILOTED at").when(p % 6 == 1, "for various groups").when(p % 6 == 2, "a grant award").when(p % 6 == 3, "pre-award and cohort").otherwise(F.col("p_type"))
    t = F.concat_ws(" ", "p_name", tail)
    return table(spark, sf_dir, "part").select("p_partkey", T.is_generic(t).alias("generic"), T.mentions_funding_process(t).alias("funding"), T.mentions_implementation(t).alias("used"))


@R.add(
    r"""SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(point, ',?\s*though the exact [^,.]+ (?:is not|are not)[^.]*\.', '.', 'g'),
  ',?\s*though (?:this|it|the) (?:figure|number|percentage|statistic)[^.]*\.', '.', 'g'), '(?i)\s*\(note:[^)]*\)', '', 'g'), '^\s+|\s+$', '', 'g') AS point
FROM (SELECT c_custkey, c_name || CASE c_custkey % 3 WHEN 0 THEN ' grew, though the exact share is not given as ' || c_nationkey || ' there.' WHEN 1 THEN ' (Note: see ' || c_mktsegment || ') stays ' ELSE ', though this figure may differ.' END AS point FROM customer)"""
)
def key_point_clean(spark, sf_dir):
    c = F.col("c_custkey")
    tail = (
        F.when(c % 3 == 0, F.concat(F.lit(" grew, though the exact share is not given as "), F.col("c_nationkey").cast("string"), F.lit(" there.")))
        .when(c % 3 == 1, F.concat(F.lit(" (Note: see "), "c_mktsegment", F.lit(") stays ")))
        .otherwise(", though this figure may differ.")
    )
    return table(spark, sf_dir, "customer").select("c_custkey", T.clean_key_point(F.concat("c_name", tail)).alias("point"))


@R.add(
    "SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN c_name END, ''), nullif(c_mktsegment, ''), '') AS title FROM customer"
)
def resolved_title(spark, sf_dir):
    c = F.col("c_custkey")
    own = F.when(c % 3 == 0, "").when(c % 3 == 1, F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", T.resolved(own, F.col("c_mktsegment")).alias("title"))


# each part as a template of two headings with a question or two
@R.add(
    """SELECT p_partkey, p_name || '|' || p_type AS headings, 'What is ' || p_brand || '?|And ' || p_size || '?||Why?' AS questions,
  chr(10) || '  "' || p_name || '"' || chr(10) || '    → What is ' || p_brand || '?' || chr(10) || '    → And ' || p_size || '?' || chr(10) || chr(10) || '  "' || p_type || '"' || chr(10) || '    → Why?' || chr(10) AS block FROM part"""
)
def template_guidance(spark, sf_dir):
    size = F.col("p_size").cast("string")
    template = F.concat(F.lit("Intro line\n\n*  "), "p_name", F.lit("\n  What is "), "p_brand", F.lit("?\n\nAnd "), size, F.lit("?\n* "), "p_type", F.lit("\n\tWhy? \n"))
    rows = table(spark, sf_dir, "part").select("p_partkey", template.alias("t"))
    g = T.template_guidance(F.col("t"))
    heads = F.array_join(F.transform(g, lambda x: x["heading"]), "|")
    asked = F.array_join(F.transform(g, lambda x: F.array_join(x["questions"], "|")), "||")
    return rows.select("p_partkey", heads.alias("headings"), asked.alias("questions"), T.guidance_block(F.col("t")).alias("block"))
