"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

OP1 = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM u
), outcome AS (
  SELECT shown.page_id, count(*) AS n, sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS good
  FROM (SELECT DISTINCT page_id, try_cast(regexp_extract(url, '^[^:]*://[^/?#]*/[^/?#]*/([0-9]+)', 1) AS BIGINT) AS doc_id FROM pages) shown
  JOIN labels ON shown.doc_id = labels.doc_id WHERE (quality = 1 AND toxic = 0) IS NOT NULL GROUP BY shown.page_id
), h AS (
  SELECT host, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(good), 0)::DOUBLE AS good,
         array_to_string(list_slice(string_split(host, '.'), greatest(1, len(string_split(host, '.')) - 1), len(string_split(host, '.'))), '.') AS domain,
         string_split(host, '.')[-1] AS suffix
  FROM p LEFT JOIN outcome ON p.page_id = outcome.page_id GROUP BY host
), d AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM h GROUP BY 1, 2),
s AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM d GROUP BY 1),
r AS (SELECT (sum(good) + 1) / (sum(n) + 2) AS m FROM s),
s1 AS (SELECT s.*, m AS prior FROM s, r),
sr AS (SELECT least(greatest(coalesce(sum(n * pow(good / n - prior, 2) - prior * (1 - prior)) / nullif(sum(prior * (1 - prior) * (n - 1)), 0), 0.001), 0.001), 0.5) AS rho FROM s1 WHERE n > 0),
s2 AS (SELECT suffix, (prior * (1 / rho - 1) + good) / (1 / rho - 1 + n) AS prior FROM s1, sr),
d1 AS (SELECT d.*, prior FROM d JOIN s2 USING (suffix)),
dr AS (SELECT least(greatest(coalesce(sum(n * pow(good / n - prior, 2) - prior * (1 - prior)) / nullif(sum(prior * (1 - prior) * (n - 1)), 0), 0.001), 0.001), 0.5) AS rho FROM d1 WHERE n > 0),
d2 AS (SELECT domain, (prior * (1 / rho - 1) + good) / (1 / rho - 1 + n) AS prior FROM d1, dr),
h1 AS (SELECT h.*, prior FROM h JOIN d2 USING (domain)),
hr AS (SELECT least(greatest(coalesce(sum(n * pow(good / n - prior, 2) - prior * (1 - prior)) / nullif(sum(prior * (1 - prior) * (n - 1)), 0), 0.001), 0.001), 0.5) AS rho FROM h1 WHERE n > 0),
h2 AS (SELECT host, n, (prior * (1 / rho - 1) + good) AS a, (1 - prior) * (1 / rho - 1) + n - good AS b FROM h1, hr),
rep AS (SELECT host, n, a / (a + b) AS rate, least(1, a / (a + b) + 1.645 * sqrt(a * b / (pow(a + b, 2) * (a + b + 1)))) AS high FROM h2),
rules(verdict, text, rhost, rpath) AS (VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
  ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')),
hosts_paths AS (SELECT DISTINCT host, path FROM p),
fit AS (
  SELECT host, path, arg_max(text, length(text)) AS rule, arg_max(verdict, length(text)) AS verdict
  FROM hosts_paths JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY 1, 2
)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, CASE WHEN high < 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       n::BIGINT AS n_labelled, round(rate, 6) AS good_rate
FROM p JOIN rep ON p.host = rep.host LEFT JOIN fit ON p.host = fit.host AND p.path = fit.path
"""

OP2 = """
WITH q AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM q a JOIN q b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""

OP4 = f"""
WITH sized AS (SELECT doc_id, source, {WORDS}::BIGINT AS size FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM src),
l AS (
  SELECT *, ((SELECT sum(source_size) FROM src)::DOUBLE * 1.5::DOUBLE
    - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM w
), t AS (SELECT source, source_size, least(cap, max(lvl) OVER () * weight) AS target FROM l),
d AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS unit
  FROM sized JOIN t ON sized.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN unit < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM d
"""

TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
         r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

OP11 = f"""
WITH q AS (SELECT DISTINCT item_id, unnest({TERMS}) AS term FROM benchmark),
d AS (SELECT row_number() OVER () AS row, doc_id, {TERMS} AS terms FROM documents),
size AS (SELECT row, doc_id, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM size),
posting AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY 1, 2
),
weight AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM posting GROUP BY 1), total
),
impact AS (
  SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))) AS x
  FROM posting JOIN size USING (row) JOIN weight USING (term), total
),
scored AS (SELECT item_id, row, doc_id, sum(x)::BIGINT AS score FROM q JOIN impact USING (term) GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 50
"""


def _field(v: str) -> str:
    return f"coalesce(strlen({v}::VARCHAR)::VARCHAR || ':' || {v}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _levels(tree: str, most: int) -> str:
    """Tables ``{tree}0`` (g, i, h) up to ``{tree}{most}``: every level of every group's tree."""
    return ",\n".join(
        f"{tree}{k + 1} AS MATERIALIZED (SELECT g, i // 3 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {tree}{k} "
        f"WHERE g IN (SELECT g FROM {tree}{k} WHERE i > 0) GROUP BY 1, 2)" for k in range(most))


def _climb(walk: str, tree: str, most: int) -> str:
    """Tables ``{walk}0`` (…, g, i, fold, proof) up to ``{walk}{most}``: one level further each."""
    out = []
    for k in range(most):
        out.append(
            f"{walk}{k + 1} AS MATERIALIZED (SELECT w.* REPLACE (CASE WHEN top.g IS NULL THEN i ELSE i // 3 END AS i, "
            f"CASE WHEN top.g IS NULL THEN fold ELSE sha256(coalesce(list_aggregate(hs[:i % 3], 'string_agg', ''), '') || fold "
            f"|| coalesce(list_aggregate(hs[i % 3 + 2:], 'string_agg', ''), '')) END AS fold, "
            f"CASE WHEN top.g IS NULL THEN proof ELSE proof || coalesce(list_aggregate(hs[:i % 3] || hs[i % 3 + 2:], 'string_agg', ''), '') END AS proof) "
            f"FROM {walk}{k} w LEFT JOIN (SELECT DISTINCT g FROM {tree}{k + 1}) top ON w.g = top.g "
            f"LEFT JOIN (SELECT g, i // 3 AS run, list(h ORDER BY i) AS hs FROM {tree}{k} GROUP BY 1, 2) r ON w.g = r.g AND w.i // 3 = r.run)")
    return ",\n".join(out)


def _op12(most: int = 13, above: int = 7) -> str:
    """Levels are written out: enough for 3^13 documents of a source and 3^7 sources."""
    top = "UNION ALL ".join(f"SELECT g, h FROM {{0}}{k} WHERE g NOT IN (SELECT g FROM {{0}}{k} WHERE i > 0) "
                            f"AND g NOT IN (SELECT g FROM {{0}}{k + 1}) " for k in range(13))
    step = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
    return f"""
WITH crc AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: {step}) ORDER BY b) AS tab FROM range(256) t(b)
),
doc AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce('s' || source, '') AS g, {_leaf('text')} AS leaf,
    {_leaf("replace(text, chr(10), '')")} AS other,
    coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda v, c: xor(v >> 8, tab[(xor(v, c) & 255) + 1])), 4294967295) % 2 = 0, false) AS tampered
  FROM documents, crc
),
t0 AS MATERIALIZED (SELECT row, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS i, leaf AS h FROM doc),
{_levels('t', most)},
subroot AS MATERIALIZED ({top.format('t')}),
u0 AS MATERIALIZED (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, h, g AS source FROM subroot),
{_levels('u', above)},
root AS MATERIALIZED (SELECT h FROM u{above} UNION ALL {" UNION ALL ".join(f"SELECT h FROM u{k} WHERE (SELECT count(*) FROM u{k}) = 1 AND (SELECT count(*) FROM u{k + 1}) = 0" for k in range(above))}),
w0 AS (SELECT doc.row, doc.g, t0.i, CASE WHEN tampered THEN other ELSE leaf END AS fold, '' AS proof FROM doc JOIN t0 USING (row)),
{_climb('w', 't', most)},
x0 AS (SELECT w.row, '' AS g, u0.i, fold, proof FROM w{most} w JOIN u0 ON w.g = u0.source),
{_climb('x', 'u', above)}
SELECT doc.doc_id, doc.leaf, subroot.h AS subroot, root.h AS root, sha256(x.proof) AS proof_sha256, x.fold AS folded_root,
  x.fold = root.h AS verified
FROM doc JOIN subroot ON doc.g = subroot.g JOIN x{above} x ON doc.row = x.row, root
"""


def statements() -> dict[str, str]:
    return {"op1_url_reputation": OP1, "op2_topk_search": OP2, "op4_mix_sources": OP4, "op11_nra_search": OP11,
            "op12_merkle_manifest": _op12()}
