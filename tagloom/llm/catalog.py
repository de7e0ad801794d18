"""The registered queries ``opN_<name>`` and, where SQL can say it, their SQL.

Each query applies its operator to a whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import (
    bpe, crosstok, decontaminate, exact_dedup, langid, licenses, nearjoin, phrases, pii, quality, repeats, sharding, wrappers,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rank_file() -> str:
    """The public vocabulary that documents are encoded by."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP1_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)
"""


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS_SQL} AS w FROM benchmark),
s AS (SELECT item, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
wins AS (SELECT DISTINCT item, k, w[i + 1:i + k] AS win FROM (SELECT *, unnest(range(0, len(w) - k + 1)) AS i FROM s)),
grams AS (
  SELECT rid, i, k, w[i + 1:i + k] AS win
  FROM (SELECT rid, w, k, unnest(range(0, len(w) - k + 1)) AS i
        FROM d, (SELECT DISTINCT k FROM s) WHERE len(w) >= k)),
hits AS (SELECT g.rid, g.i, g.k, x.item FROM grams g JOIN wins x ON g.win = x.win),
n AS (SELECT rid, count(*) AS n_hit
      FROM (SELECT DISTINCT rid, unnest(range(i, i + k)) AS at FROM hits) GROUP BY rid),
m AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN m USING (rid)
"""


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def _op4_sql() -> str:
    """For each kind: pieces and matches, places from their lengths, the checks."""

    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    digits = "regexp_replace(s.v, '[^0-9]', '', 'g')"
    luhn = (
        f"(length({digits}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length({digits}) + 1), lambda i: "
        f"CASE WHEN i % 2 = 1 THEN ascii(reverse({digits})[i]) - 48 "
        f"WHEN ascii(reverse({digits})[i]) < 53 THEN 2 * (ascii(reverse({digits})[i]) - 48) "
        f"ELSE 2 * (ascii(reverse({digits})[i]) - 48) - 9 END)) % 10 = 0)"
    )
    plain = "replace(s.v, ' ', '')"
    turned = f"({plain}[5:] || {plain}[1:4])"
    confirm = {
        "email": "true",
        "ip": "list_aggregate(list_transform(string_split(s.v, '.'), lambda x: length(ltrim(x, '0')) <= 3 AND "
        "CAST(('0' || right(ltrim(x, '0'), 3)) AS INT) <= 255), 'bool_and')",
        "card": luhn,
        "phone": f"length({digits}) BETWEEN 9 AND 15",
        "iban": f"length({plain}) BETWEEN 15 AND 34 AND mod97({turned}) = 1",
        "ssn": "regexp_matches(lower(s.near), 'ssn|social|security')",
    }
    ctes = []
    for kind, pattern in pii.PLAIN.items():
        q = quoted(pattern)
        ctes.append(
            f"{kind} AS (SELECT rid, list_filter(list_transform(range(1, len(m) + 1), lambda i: {{"
            f"'a': list_sum(list_transform(p[1:i], lambda x: length(x))) "
            f"+ coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0), "
            f"'v': m[i], 'near': right(p[i], {pii.NEAR}) || ' ' || left(p[i + 1], {pii.NEAR})}}), "
            f"lambda s: {confirm[kind]}) AS s FROM (SELECT rid, regexp_extract_all(t, {q}) AS m, "
            f"string_split_regex(t, {q}) AS p FROM d))"
        )
    told = {
        kind: f"list_transform({kind}.s, lambda z: '{kind}:' || CAST(z.a AS BIGINT) || ':' || CAST(z.a + length(z.v) AS BIGINT))"
        for kind in pii.PLAIN
    }
    base = "array_to_string(flatten([" + ", ".join(told[k] for k in pii.BASE) + "]), ',')"
    every = "array_to_string(flatten([" + ", ".join(told.values()) + "]), ',')"
    counts = ", ".join(f"CAST(len({k}.s) AS BIGINT) AS n_{k}" for k in pii.PLAIN)
    joins = " ".join(f"JOIN {k} USING (rid)" for k in pii.PLAIN)
    head = "WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), "
    rest = (
        "list_reduce(list_prepend(0, list_transform(range(1, length(X) + 1), lambda i: ascii(X[i]))), "
        "lambda r, c: CASE WHEN c < 65 THEN (r * 10 + c - 48) % 97 ELSE (r * 100 + c - 55) % 97 END)"
    )
    ctes = [c.replace(f"mod97({turned})", rest.replace("X", turned)) for c in ctes]
    return f"{head}{', '.join(ctes)} SELECT doc_id, {counts}, sha256({base}) AS base_sha256, {every} AS spans FROM d {joins}"


def op5_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(table(spark, sf_dir, "documents"))


def _op6_sql() -> str:
    """Blocks by brute force: each run of as many words as a template has."""
    texts = [(t, label, True) for t, label in licenses.PHRASES.items()]
    texts += [(t, label, False) for t, label in licenses.TEMPLATES.items()]
    values = ", ".join(f"({i}, '{t}', '{label}', {phrase})" for i, (t, label, phrase) in enumerate(texts))
    top, of = licenses.THRESHOLD.as_integer_ratio()
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS_SQL} AS w FROM documents),
t AS (SELECT tid, label, phrase, string_split(body, ' ') AS words, list_distinct(string_split(body, ' ')) AS k
      FROM (VALUES {values}) AS v(tid, body, label, phrase)),
b AS (SELECT rid, tid, label, phrase, words, k, i, w[i + 1:i + len(words)] AS x
      FROM (SELECT rid, w, tid, label, phrase, words, k, unnest(range(0, len(w))) AS i FROM d, t
            WHERE len(list_intersect(w, k)) * {of} >= {top} * len(k))),
m AS (SELECT rid, tid, label, phrase, i, len(list_intersect(x, k)) / len(k) AS share FROM b
      WHERE CASE WHEN phrase THEN x = words ELSE len(list_intersect(x, k)) * {of} >= {top} * len(k) END),
a AS (SELECT rid, count(*) FILTER (phrase) AS n_base, min(i) FILTER (phrase) AS first_word,
             max(i) FILTER (phrase) AS last_word, max(share) AS score,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM m GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN a USING (rid)
"""


def op7_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearjoin.near_duplicates(table(spark, sf_dir, "documents")).drop("node")


OP7_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + k], ' ') AS s
      FROM (SELECT doc_id, w, least(len(w), 5) AS k, unnest(range(0, len(w) - least(len(w), 5) + 1)) AS i
            FROM d WHERE len(w) > 0)),
t AS (SELECT doc_id, list_sort(list(s)) AS s FROM g GROUP BY doc_id),
c AS (SELECT s, min(doc_id) AS set_id, count(*) AS n_copies, len(s) AS n FROM t GROUP BY s),
e AS (SELECT set_id, n, unnest(s) AS s FROM c),
p AS (SELECT x.set_id AS a, y.set_id AS b FROM e x JOIN e y ON x.s = y.s AND x.set_id <> y.set_id
      GROUP BY x.set_id, y.set_id, x.n, y.n HAVING 9 * count(*) >= 4 * (x.n + y.n)),
r AS (SELECT set_id, set_id AS root FROM c UNION SELECT p.b, r.root FROM r JOIN p ON p.a = r.set_id),
m AS (SELECT set_id, min(root) AS class_id FROM r GROUP BY set_id),
k AS (SELECT a AS set_id, count(*) AS n_links FROM p GROUP BY a)
SELECT d.doc_id, coalesce(m.class_id, d.doc_id) AS class_id, coalesce(c.set_id, d.doc_id) AS set_id,
       coalesce(c.n_copies, 1) AS n_copies, coalesce(k.n_links, 0) AS n_links
FROM d LEFT JOIN t ON t.doc_id = d.doc_id LEFT JOIN c ON c.s = t.s
LEFT JOIN m ON m.set_id = c.set_id LEFT JOIN k ON k.set_id = c.set_id
"""


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), bpe.read_ranks(rank_file()))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 13], ' ') AS win
      FROM (SELECT doc_id, w, unnest(range(0, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
o AS (SELECT win, min(doc_id) AS owner FROM g GROUP BY win),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM g JOIN o USING (win) WHERE owner < doc_id),
k AS (SELECT doc_id, count(*) AS n_words, count(r.pos) AS n_removed,
             coalesce(string_agg(x.word, ' ' ORDER BY x.pos) FILTER (r.pos IS NULL), '') AS kept
      FROM (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM d) x
      LEFT JOIN r USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.reshard(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_extract_all(t, '[^.,;:!?\x0A-\x0D]+')), '[^\x20\x09]+') AS w FROM t),
g AS (SELECT lang, k, array_to_string(w[i + 1:i + k], ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM p, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, phrase, any_value(k) AS k, count(*) AS f FROM g GROUP BY lang, phrase HAVING count(*) >= 100),
n AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM p GROUP BY lang),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
x AS (SELECT DISTINCT b.lang, b.phrase FROM (
        SELECT lang, array_to_string(w[i + 1:i + m], ' ') AS phrase, a
        FROM (SELECT lang, w, a, m, unnest(range(0, k - m + 1)) AS i FROM c, (SELECT unnest(range(2, 5)) AS m) WHERE m < k)) s
      JOIN c b ON b.lang = s.lang AND b.phrase = s.phrase AND 100 * s.a >= 100 * b.a),
cut AS (SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS lp, array_to_string(w[j + 1:k], ' ') AS rp
        FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
s AS (SELECT cut.lang, cut.phrase, cut.a, l.f AS l, r.f AS r, n.n, j, (1000 * cut.a::HUGEINT * n.n) // (l.f::HUGEINT * r.f) AS score
      FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = lp JOIN f r ON r.lang = cut.lang AND r.phrase = rp
      JOIN n ON n.lang = cut.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
k AS (SELECT b.* FROM b ANTI JOIN x ON x.lang = b.lang AND x.phrase = b.phrase),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM k)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM o WHERE rank <= 2000
"""


def op12_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return crosstok.align(table(spark, sf_dir, "documents"), a, b)


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = langid.identify(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "held_out", "lang_pred", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_quality": op3_quality,
    "op4_pii": op4_pii,
    "op5_extract": op5_extract,
    "op6_licenses": op6_licenses,
    "op7_near_join": op7_near_join,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_repeats": op9_repeats,
    "op10_sharding": op10_sharding,
    "op11_collocations": op11_collocations,
    "op12_cross_tokens": op12_cross_tokens,
    "op13_language": op13_language,
}
ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": OP1_SQL,
    "op2_decontaminate": OP2_SQL,
    "op4_pii": _op4_sql(),
    "op6_licenses": _op6_sql(),
    "op7_near_join": OP7_SQL,
    "op9_repeats": OP9_SQL,
    "op11_collocations": OP11_SQL,
}
