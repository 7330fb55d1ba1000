"""The queries opN_<name> over the tables of a folder, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import lattice_sampling, license_scan, near_dedup, order_minhash, poisson_mix, prefix_forest, quality_ftrl, secret_scan, token_attribution, url_cascade
from .common import UPPER, table


def op1_token_attribution(spark, sf_dir):
    return token_attribution.count_tokens(table(spark, sf_dir, "documents"))


def op2_order_minhash(spark, sf_dir):
    return order_minhash.compare_with_edits(table(spark, sf_dir, "documents"))


def op3_poisson_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return poisson_mix.mix(docs, alpha=0.5, seed=17)


OP3_SQL = """
WITH c AS (SELECT coalesce(source, '') AS s, count(*) AS n FROM documents GROUP BY 1),
r AS (SELECT s, n, sqrt(n) / (sum(sqrt(n)) OVER ()) * (sum(n) OVER ()) / n AS rate FROM c),
k AS (SELECT s, rate, unnest(generate_series(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS INTEGER))) AS k FROM r),
f AS (SELECT s, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY s ORDER BY k) AS f FROM k),
cdf AS (SELECT s, list(f ORDER BY k) AS cdf FROM f GROUP BY s),
u AS (SELECT d.*, cdf.cdf, coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, ''))) AS key FROM documents d JOIN cdf ON coalesce(d.source, '') = cdf.s),
v AS (SELECT *, CAST('0x' || substr(md5('17:0:' || key), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM u),
n AS (SELECT *, CAST(len(list_filter(cdf, lambda x: x <= u)) AS INTEGER) AS n_copies FROM v),
e AS (SELECT *, unnest(generate_series(1, n_copies)) AS copy FROM n WHERE n_copies > 0)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy, n_copies,
       CAST('0x' || substr(md5('17:order:' || key || ':' || copy), 1, 15) AS BIGINT) AS shuffle_key
FROM e
"""


def op4_lattice_sampling(spark, sf_dir):
    return lattice_sampling.sample(table(spark, sf_dir, "documents"), k=2, seed=11)


def op5_prefix_forest(spark, sf_dir):
    return prefix_forest.search(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op6_near_dedup(spark, sf_dir):
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op8_quality_ftrl(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_ftrl.score(docs, quality_ftrl.train(docs, table(spark, sf_dir, "labels")))


def op9_url_cascade(spark, sf_dir):
    """The list of blocked keys stands for one that would be given: every key whose MD5 begins with 0."""
    return url_cascade.judge(table(spark, sf_dir, "pages"), lambda key: F.md5(key).startswith("0"))


def _op9_sql() -> str:
    fits = [
        (said, h + p, f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))")
        for said, h, p in sorted(url_cascade.RULES, key=lambda r: -len(r[1] + r[2]))
    ]
    rule = "CASE " + " ".join(f"WHEN {test} THEN '{name}'" for _, name, test in fits) + " END"
    said = "CASE " + " ".join(f"WHEN {test} THEN '{verdict}'" for verdict, _, test in fits) + " END"
    return f"""
WITH a AS (SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
b AS (SELECT page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), '{UPPER}', '{UPPER.lower()}') AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM a)
SELECT page_id, host, path, {rule} AS rule,
       coalesce({said}, CASE WHEN starts_with(md5(host || path), '0') THEN 'block' ELSE 'allow' END) AS verdict
FROM b
"""


def op10_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


def _op10_sql() -> str:
    word = license_scan.WORD
    places, labels, shares, names = [], [], [], []
    for phrase, label in license_scan.PHRASES:
        test = " AND ".join(f"ws[i + {d + 1}] = '{p}'" for d, p in enumerate(phrase.split()))
        places.append(f"list_filter(range(len(ws)), lambda i: {test})")
        labels.append(label)
    quoted = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    for p in license_scan.plan_templates(license_scan.TEMPLATES, {}, license_scan.THRESHOLD):
        blocks = f"list_transform(range((len(ws) + {p['hop'] - 1}) // {p['hop']}), lambda k: list_distinct(ws[k * {p['hop']} + 1 : (k + 2) * {p['hop']}]))"
        both = f"len(list_intersect(b, {quoted(p['words'])}))"
        shares.append(f"coalesce(list_max(list_transform({blocks}, lambda b: CASE WHEN {both} >= {p['need']} AND list_has_all(b, {quoted(p['marks'])}) THEN {both} / {len(p['words'])}.0 ELSE 0.0 END)), 0.0)")
        names.append(p["label"])
    base = ", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{x}' END" for i, x in enumerate(labels))
    own = ", ".join(f"CASE WHEN s{i} > 0 THEN '{x}' END" for i, x in enumerate(names))
    join = lambda xs: f"array_to_string(list_sort(list_distinct(list_filter([{xs}], lambda x: x IS NOT NULL))), ',')"
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{word}') AS ws FROM documents),
p AS (SELECT doc_id, len(ws) AS n_words, {', '.join(f'{x} AS p{i}' for i, x in enumerate(places))},
             {', '.join(f'{x} AS s{i}' for i, x in enumerate(shares))} FROM w),
q AS (SELECT *, {' || '.join(f'p{i}' for i in range(len(places)))} AS all_places FROM p)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(all_places) AS BIGINT) AS n_base,
       CAST(list_min(all_places) AS BIGINT) AS first_word, CAST(list_max(all_places) AS BIGINT) AS last_word,
       {join(base)} AS base_labels, {join(base + ', ' + own)} AS labels,
       CAST(CASE WHEN len(all_places) > 0 THEN 1.0 ELSE greatest({', '.join(f's{i}' for i in range(len(shares)))}) END AS DOUBLE) AS score
FROM q
"""


QUERIES = {
    "op1_token_attribution": op1_token_attribution,
    "op2_order_minhash": op2_order_minhash,
    "op3_poisson_mix": op3_poisson_mix,
    "op4_lattice_sampling": op4_lattice_sampling,
    "op5_prefix_forest": op5_prefix_forest,
    "op6_near_dedup": op6_near_dedup,
    "op7_secret_scan": op7_secret_scan,
    "op8_quality_ftrl": op8_quality_ftrl,
    "op9_url_cascade": op9_url_cascade,
    "op10_license_scan": op10_license_scan,
}
ORACLES = {
    "op3_poisson_mix": OP3_SQL,
    "op9_url_cascade": _op9_sql(),
    "op10_license_scan": _op10_sql(),
}
