"""The registered queries of this subpackage and their SQL statements."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

from lumentab.llm import (
    dac, decontaminate, language, licenses, mixing, mtree, ngramjoin, quality, secret_scan, spelling, templates, tokencount, turns,
)
from lumentab.llm.ship_code import prepare

Plan = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def add(plan: Plan) -> Plan:
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = dedent(sql).strip()
        return plan

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_decontaminate", sql=r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
         i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
         win AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS g FROM (
                   SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
         widths AS (SELECT DISTINCT k FROM win),
         occ AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS g FROM (
                   SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, widths WHERE len(w) >= k)),
         m AS (SELECT doc_id, item_id, k, p FROM occ JOIN win USING (k, g)),
         hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM m) GROUP BY doc_id),
         it AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
                FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(ids, '') AS item_ids
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
    """)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_extract")
def op2_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract(table(spark, sf_dir, "pages"))


@query("op3_language")
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def _secrets_sql() -> str:
    """Matches and the text between them, their lengths added up to offsets."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"  # noqa: E731
    parts, kinds = [], []
    for n, rule in enumerate(secret_scan.RULES):
        kinds.append(rule.kind)
        parts.append(f"""
            SELECT doc_id, {n} AS k, '{rule.kind}' AS kind, {rule.base} AS base,
                   CAST(list_sum([len(x) for x in p[1:i]]) + coalesce(list_sum([len(x) for x in m[1:i - 1]]), 0) AS BIGINT) AS s, len(m[i]) AS size
            FROM (SELECT doc_id, m, g, p, unnest(range(1, len(m) + 1)) AS i FROM (
                    SELECT doc_id, regexp_extract_all(coalesce(text, ''), {quote(rule.pattern)}) AS m,
                           regexp_extract_all(coalesce(text, ''), {quote(rule.pattern)}, {rule.group}) AS g,
                           string_split_regex(coalesce(text, ''), {quote(rule.pattern)}) AS p FROM documents))
            WHERE len(g[i]) >= {rule.least}""")
    counts = ", ".join(f"count(s) FILTER (kind = '{k}') AS n_{k}" for k in kinds)
    return f"""
        WITH found AS ({" UNION ALL ".join(parts)})
        SELECT doc_id, {counts},
               sha256(coalesce(string_agg(kind || ':' || s || ':' || (s + size), ',' ORDER BY s, k) FILTER (base), '')) AS base_sha256,
               coalesce(string_agg(kind || ':' || s || ':' || (s + size), ',' ORDER BY s, k), '') AS spans
        FROM documents LEFT JOIN found USING (doc_id) GROUP BY doc_id"""


@query("op4_secrets", sql=_secrets_sql())
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query("op5_quality", sql=r"""
    WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
         lines AS (SELECT doc_id, CAST(sum(n - 1) AS BIGINT) AS n_dup_lines FROM (
                     SELECT doc_id, l, count(*) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
                     WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id, l) GROUP BY doc_id),
         win AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, array_to_string(w[p:p + 7], ' ')) AS n FROM (
                   SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM d WHERE len(w) >= 8)),
         rep AS (SELECT doc_id, count(DISTINCT q) AS n_repeat_words FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM win WHERE n > 1) GROUP BY doc_id),
         m AS (SELECT doc_id, source, len(w) AS n_words, coalesce(CAST(list_sum([len(x) for x in w]) AS BIGINT), 0) AS word_chars,
                      len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
                      coalesce(n_repeat_words, 0) AS n_repeat_words FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
         f AS (SELECT *, n_words < 20 AS r1, 100 * n_repeat_words > 30 * n_words AS r2, 10 * n_symbols > n_words AS r3,
                      word_chars > 15 * n_words OR word_chars < 2 * n_words AS r4, 20 * n_dup_lines > n_words AS r5 FROM m),
         rates AS (SELECT source, r, count(*) AS n, sum(CAST(bad AS INT)) AS k, avg(CAST(bad AS INT)) AS rate FROM (
                     SELECT source, unnest([1, 2, 3, 4, 5]) AS r, unnest([r1, r2, r3, r4, r5]) AS bad FROM f WHERE source IS NOT NULL) GROUP BY ALL),
         prior AS (SELECT r, avg(rate) AS mean, CASE WHEN var_pop(rate) > 0
                     THEN least(greatest(avg(rate) * (1 - avg(rate)) / var_pop(rate) - 1, 1), 1e6) ELSE 1e6 END AS strength FROM rates GROUP BY r),
         strict AS (SELECT DISTINCT source FROM rates JOIN prior USING (r) WHERE (k + mean * strength) / (n + strength) >= 0.5)
    SELECT doc_id, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r1 OR r2 AS base_failed,
           NOT (r1 OR r2) AND NOT ((r1 OR r2 OR r3 OR r4 OR r5) AND coalesce(source IN (FROM strict), false)) AS kept FROM f
    """)
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


@query("op7_ngram_join", sql=r"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x20\x09-\x0D]+') AS w FROM documents),
         sh AS (SELECT DISTINCT doc_id, hash(array_to_string(w[p:p + 3], ' ')) AS g FROM (
                  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM d WHERE len(w) > 0)),
         n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
         link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM sh AS a JOIN sh AS b USING (g) JOIN n AS x ON x.doc_id = a.doc_id JOIN n AS y ON y.doc_id = b.doc_id
                  WHERE a.doc_id <> b.doc_id AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n) GROUP BY a.doc_id, b.doc_id, x.n, y.n
                  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
         reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT doc_id, b FROM reach JOIN link ON other = a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN n USING (doc_id)
    """)
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.jaccard_components(table(spark, sf_dir, "documents"))


@query("op8_licenses", sql=licenses.oracle())
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op9_token_file")
def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.token_file(table(spark, sf_dir, "documents"))


@query("op10_mixing")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op11_topk", sql="""
    WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
         s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.v, x.v) AS BIGINT) AS score
               FROM e AS q JOIN e AS x ON q.vec_id <> x.vec_id WHERE q.vec_id % 20 = 0),
         r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """)
def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"))


#: One row with the table of the checksum, and the checksum of a text ``{}`` by it.
_CRC_TABLE = """SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v FROM range(256) AS x(i))"""
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, len(hex(encode({0}))), 2),
    lambda p: CAST('0x' || hex(encode({0}))[p:p + 1] AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""


def _repair_sql() -> str:
    """A walk over the turns that keeps, for each state of the grammar (nothing yet, s, u, a), the least (cost, audit) and its text."""
    def edit(state: str, letter: str, cost: str, line: str) -> str:
        gap = f"CASE WHEN {state}.o = '' THEN '' ELSE chr(10) END"
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {state}.o || {gap} || {line}}}"

    def turn(state: str, to: str) -> str:
        """The turn in a place for u or a; a turn that must go costs too much there."""
        role = {"u": "user", "a": "assistant"}[to]
        kept = edit(state, "K", "x.fix", "x.role || ':' || x.text")
        return f"CASE WHEN x.one = '{to}' THEN {kept} ELSE {edit(state, 'R', 'x.fix + 3', f"'{role}:' || x.text")} END"

    def insert(state: str, role: str) -> str:
        return edit(state, "I", "3", f"'{role}:'")

    def opened(states: str) -> str:
        """Insertions after what is there: first u, then a, then u again."""
        u = f"list_transform([{states}], lambda t: [t[1], t[2], list_min([t[3], {insert('t[1]', 'user')}, {insert('t[2]', 'user')}, {insert('t[4]', 'user')}]), t[4]])[1]"
        return f"list_transform([{u}], lambda t: [t[1], t[2], t[3], list_min([t[4], {insert('t[3]', 'assistant')}])])[1]"

    gone = lambda n: f"{{'c': acc.s[{n}].c + 4, 'a': acc.s[{n}].a || 'D', 'o': acc.s[{n}].o}}"  # noqa: E731
    system = f"CASE WHEN x.one = 's' THEN {edit('acc.s[1]', 'K', 'x.fix', "x.role || ':' || x.text")} ELSE {gone(2)} END"
    walked = (f"[{gone(1)}, list_min([{gone(2)}, {system}]), list_min([{gone(3)}, {turn('acc.s[1]', 'u')}, {turn('acc.s[2]', 'u')}, {turn('acc.s[4]', 'u')}]), "
              f"list_min([{gone(4)}, {turn('acc.s[3]', 'a')}])]")
    far = "{'c': CAST(1000000000 AS BIGINT), 'a': '', 'o': ''}"
    start = opened(f"[{{'c': CAST(0 AS BIGINT), 'a': '', 'o': ''}}, {far}, {far}, {far}]")
    return rf"""
        WITH crc AS ({_CRC_TABLE}),
             k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                          (coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')) AS key FROM conversations),
             h AS (SELECT k.*, {_CRC.format("key")} % 20 AS kind FROM k, crc),
             d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
                          CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                          unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM h WHERE kind <> 0),
             o AS (SELECT *, sha256(len(role) || ':' || role || text) AS mark FROM d),
             r AS (SELECT *, role[1:1] AS one, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, mark, copy) AS i,
                          row_number() OVER (PARTITION BY conv_id, mark ORDER BY turn NULLS FIRST, role, copy) AS seen,
                          lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, mark, copy) AS before FROM o),
             f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 1 WHEN seen > 1 THEN 2
                                  WHEN NOT regexp_matches(text, '[.!?][ 	-]*\z') THEN 3 ELSE 0 END AS fault FROM r),
             g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
                          count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                          count(*) FILTER (before IS NOT NULL AND before || one NOT IN ('su', 'ua', 'au')) AS illegal,
                          list({{'one': one, 'role': role, 'text': text, 'fix': CAST(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 3 ELSE 1000000 END AS BIGINT), 's': {start}}} ORDER BY i) AS turns
                   FROM f GROUP BY conv_id),
             e AS (SELECT *, list_reduce(list_prepend({{'one': '', 'role': '', 'text': '', 'fix': CAST(0 AS BIGINT), 's': {start}}}, turns),
                          lambda acc, x: {{'one': x.one, 'role': x.role, 'text': x.text, 'fix': x.fix, 's': {opened(walked)}}}).s AS s FROM g),
             b AS (SELECT *, list_min([s[1], s[4]]) AS best FROM e)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(best.o, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS c LEFT JOIN b ON c.conv_id IS NOT DISTINCT FROM b.conv_id"""


@query("op12_turn_repair", sql=_repair_sql())
def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repaired(table(spark, sf_dir, "conversations"))


@query("op13_variants", sql=f"""
    WITH RECURSIVE crc AS ({_CRC_TABLE}),
         runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]{{7,}}')),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r FROM documents),
         each AS (SELECT id, r, count(*) AS n FROM runs GROUP BY ALL),
         hashed AS (SELECT r, n, {_CRC.format("(id || ':' || r)")} AS h FROM each, crc),
         made AS (SELECT CASE WHEN h % 31 = 0 THEN r[1:h % len(r)] || r[h % len(r) + 2:] ELSE r END AS word, n FROM hashed),
         w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE len(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
         less AS (SELECT word, i, word[1:i - 1] || word[i + 1:] AS v FROM (SELECT word, unnest(range(1, len(word) + 1)) AS i FROM w)),
         near AS (SELECT a.word AS word, b.word AS other FROM less AS a JOIN less AS b USING (v, i) WHERE a.word <> b.word
                  UNION SELECT word, v FROM less WHERE v IN (SELECT word FROM w)
                  UNION SELECT v, word FROM less WHERE v IN (SELECT word FROM w)),
         best AS (SELECT near.word AS word, count(*) AS n_near, min(row(-w.n, other)) AS b FROM near JOIN w ON w.word = other GROUP BY near.word),
         f AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b[1] >= 10 * n THEN b[2] END AS form,
                      CASE WHEN -b[1] >= 10 * n THEN -b[1] END AS form_n FROM w LEFT JOIN best ON w.word = best.word),
         path AS (SELECT word, word AS root FROM f UNION ALL SELECT path.word, f.form FROM path JOIN f ON f.word = root WHERE f.form IS NOT NULL),
         last AS (SELECT path.word, root FROM path JOIN f ON f.word = root WHERE f.form IS NULL)
    SELECT f.word, form, root, n, n_near, form_n FROM f JOIN last ON last.word = f.word
    """)
def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))
