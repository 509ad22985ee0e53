"""The adapter views once more, as SQL: the independent side of the comparison."""

from __future__ import annotations

from cladeworks.functions.codons import code_of

ALIGNMENT = """alignment AS (
  SELECT CAST(event_id % 5 + 1 AS INT) AS taxon_id, event_id // 5 + 1 AS site,
    CASE WHEN value < 12.0 THEN CASE event_type WHEN 'click' THEN 'T' WHEN 'error' THEN 'C' WHEN 'purchase' THEN 'A' WHEN 'signup' THEN 'G' WHEN 'view' THEN '-' END
         ELSE substr('TCAG', CAST(((event_id // 5 + 1) * 13 + event_id // 35) % 4 + 1 AS INT), 1) END AS state
  FROM events)"""
COLUMNS = ALIGNMENT + ", cols AS (SELECT site, string_agg(state, '' ORDER BY taxon_id) AS pattern FROM alignment GROUP BY site)"
PATTERNS = COLUMNS + ", patterns AS (SELECT pattern, count(*) AS fpatt FROM cols GROUP BY pattern)"
KNOWN = "('T', 'C', 'A', 'G')"
PAIRS = ALIGNMENT + f""", pairs AS (SELECT a.taxon_id AS i, b.taxon_id AS j, a.state AS a, b.state AS b, count(*) AS n
  FROM alignment a JOIN alignment b ON a.site = b.site AND a.taxon_id > b.taxon_id
  WHERE a.state IN {KNOWN} AND b.state IN {KNOWN} GROUP BY ALL)"""
MARGIN = ", ".join(f"sum(CASE WHEN a = '{x}' THEN n ELSE 0 END + CASE WHEN b = '{x}' THEN n ELSE 0 END) / (2.0 * sum(n)) AS p{x}" for x in "TCAG")
TERMS = PAIRS + f""", sums AS (SELECT i, j, {MARGIN},
    sum(CASE WHEN a <> b THEN n ELSE 0 END) / (1.0 * sum(n)) AS fd,
    sum(CASE WHEN a || b IN ('TC', 'CT') THEN n ELSE 0 END) / (1.0 * sum(n)) AS p1,
    sum(CASE WHEN a || b IN ('AG', 'GA') THEN n ELSE 0 END) / (1.0 * sum(n)) AS p2 FROM pairs GROUP BY i, j),
  terms AS (SELECT *, fd - p1 - p2 AS q, pT + pC AS y, pA + pG AS r, pT * pC AS tc, pA * pG AS ag FROM sums)"""


def minus_log(u: str) -> str:
    return f"(CASE WHEN ({u}) > 0 THEN -ln({u}) END)"


A1, A2 = minus_log("1 - y * p1 / (2 * tc) - q / (2 * y)"), minus_log("1 - r * p2 / (2 * ag) - q / (2 * r)")
V = minus_log("1 - q / (2 * y * r)")
GC = "(2 * (pG + pC) * (1 - pG - pC))"
B81 = "(pT * (1 - pT) + pC * (1 - pC) + pA * (1 - pA) + pG * (1 - pG))"
F84_A = f"({minus_log('(2 * (tc + ag) + 2 * (tc * r / y + ag * y / r) * (1 - q / (2 * y * r)) - p1 - p2) / (2 * tc / y + 2 * ag / r)')} / 2)"
F84_V = f"({V} / 2)"
F84_K = f"(CASE WHEN {F84_V} > 0 THEN greatest({F84_A} / {F84_V} - 1, -0.5) ELSE 999.0 END)"
DISTANCES = {
    "p": "fd",
    "jc69": f"0.75 * {minus_log('1 - fd / 0.75')}",
    "f81": f"{B81} * {minus_log(f'1 - fd / {B81}')}",
    "k80": f"{minus_log('1 - 2 * (p1 + p2) - q')} / 2 + {minus_log('1 - 2 * q')} / 4",
    "f84": f"4 * {F84_V} * (tc * (1 + {F84_K} / y) + ag * (1 + {F84_K} / r) + y * r)",
    "hky85": f"(tc + ag) * (({A1} - r * {V}) / y + ({A2} - y * {V}) / r) + 2 * y * r * {V}",
    "t92": f"{GC} * {minus_log(f'1 - q - (p1 + p2) / {GC}')} + (1 - {GC}) * {minus_log('1 - 2 * q')} / 2",
    "tn93": f"2 * tc * ({A1} - r * {V}) / y + 2 * ag * ({A2} - y * {V}) / r + 2 * y * r * {V}",
    "jc69_gamma": "CASE WHEN 1 - fd / 0.75 > 0 THEN -0.75 * 0.5 * (1 - pow(1 - fd / 0.75, -2.0)) END",
}


def distance_sql(name: str) -> str:
    return f"WITH {TERMS} SELECT i, j, round(CASE WHEN fd < 1e-10 THEN 0.0 ELSE {DISTANCES[name]} END, 6) + 0.0 AS distance FROM terms"


CODONS = ALIGNMENT + """, codon_rows AS (SELECT taxon_id, (site - 1) // 3 + 1 AS codon_site, string_agg(state, '' ORDER BY site) AS codon
  FROM alignment GROUP BY 1, 2 HAVING count(*) = 3)"""
CODES = "codes(codon, aa) AS (VALUES " + ", ".join(f"('{c}', '{a}')" for c, a in code_of().items()) + ")"
CODON_PAIRS = CODONS + f""", {CODES}, met AS (SELECT a.taxon_id AS i, b.taxon_id AS j, a.codon AS ca, b.codon AS cb, count(*) AS n
  FROM codon_rows a JOIN codon_rows b ON a.codon_site = b.codon_site AND a.taxon_id > b.taxon_id
  WHERE a.codon IN (SELECT codon FROM codes WHERE aa <> '*') AND b.codon IN (SELECT codon FROM codes WHERE aa <> '*') GROUP BY ALL)"""
MUTANTS = """, bases(base) AS (VALUES ('T'), ('C'), ('A'), ('G')), places(k) AS (VALUES (1), (2), (3)),
  mutants AS (SELECT c.codon, k, c.aa, m.aa AS aa2 FROM codes c, places, bases
    JOIN codes m ON m.codon = substr(c.codon, 1, k - 1) || base || substr(c.codon, k + 1) WHERE m.codon <> c.codon AND c.aa <> '*')"""
NG86 = f"""WITH {CODON_PAIRS}{MUTANTS},
  sites AS (SELECT codon, sum(CASE WHEN aa2 = aa THEN 1 ELSE 0 END) / 3.0 AS s, sum(CASE WHEN aa2 NOT IN (aa, '*') THEN 1 ELSE 0 END) / 3.0 AS n FROM mutants GROUP BY codon),
  orders(p, q, r) AS (VALUES (1, 2, 3), (1, 3, 2), (2, 1, 3), (2, 3, 1), (3, 1, 2), (3, 2, 1)),
  distinct_pairs AS (SELECT DISTINCT ca, cb FROM met),
  one AS (SELECT *, substr(ca, 1, p - 1) || substr(cb, p, 1) || substr(ca, p + 1) AS c1 FROM distinct_pairs, orders),
  two AS (SELECT *, substr(c1, 1, q - 1) || substr(cb, q, 1) || substr(c1, q + 1) AS c2 FROM one),
  walked AS (SELECT ca, cb, w.aa AS a0, x.aa AS a1, y.aa AS a2, z.aa AS a3, c1, c2 FROM two JOIN codes w ON w.codon = ca JOIN codes x ON x.codon = c1 JOIN codes y ON y.codon = c2 JOIN codes z ON z.codon = cb),
  steps AS (SELECT ca, cb,
      (CASE WHEN ca <> c1 AND a0 = a1 THEN 1 ELSE 0 END) + (CASE WHEN c1 <> c2 AND a1 = a2 THEN 1 ELSE 0 END) + (CASE WHEN c2 <> cb AND a2 = a3 THEN 1 ELSE 0 END) AS s,
      (CASE WHEN a0 <> a1 THEN 1 ELSE 0 END) + (CASE WHEN a1 <> a2 THEN 1 ELSE 0 END) + (CASE WHEN a2 <> a3 THEN 1 ELSE 0 END) AS n
    FROM walked WHERE a1 <> '*' AND a2 <> '*'),
  changes AS (SELECT ca, cb, avg(s) AS s, avg(n) AS n FROM steps GROUP BY ca, cb),
  sums AS (SELECT i, j, sum(m.n) AS codons, sum(m.n * (x.s + y.s) / 2) AS s0, sum(m.n * (x.n + y.n) / 2) AS n0, sum(m.n * coalesce(c.s, 0)) AS sd, sum(m.n * coalesce(c.n, 0)) AS nd
    FROM met m JOIN sites x ON x.codon = m.ca JOIN sites y ON y.codon = m.cb LEFT JOIN changes c ON c.ca = m.ca AND c.cb = m.cb GROUP BY i, j),
  scaled AS (SELECT i, j, s0 * 3 * codons / (s0 + n0) AS s, n0 * 3 * codons / (s0 + n0) AS n, sd, nd FROM sums)
  SELECT i, j, round(s, 6) + 0.0 AS s, round(n, 6) + 0.0 AS n,
    round(CASE WHEN sd / s < 0.75 THEN -0.75 * ln(1 - sd / s * 4 / 3) END, 6) + 0.0 AS ds, round(CASE WHEN nd / n < 0.75 THEN -0.75 * ln(1 - nd / n * 4 / 3) END, 6) + 0.0 AS dn FROM scaled"""


def _class_terms(k: int) -> str:
    p, q = f"(ts{k} / l{k})", f"(tv{k} / l{k})"
    u, v = f"(1 - 2 * {p} - {q})", f"(1 - 2 * {q})"
    return f"CASE WHEN {u} > 0 AND {v} > 0 THEN -0.5 * ln({u}) + 0.25 * ln({v}) END AS a{k}, CASE WHEN {v} > 0 THEN -0.5 * ln({v}) END AS b{k}"


LWL85 = f"""WITH {CODON_PAIRS}{MUTANTS},
  degeneracy AS (SELECT codon, k, CASE sum(CASE WHEN aa2 = aa THEN 1 ELSE 0 END) WHEN 0 THEN 0 WHEN 3 THEN 4 ELSE 2 END AS d FROM mutants GROUP BY codon, k),
  sides AS (SELECT i, j, n, substr(ca, k, 1) AS a, substr(cb, k, 1) AS b, d FROM met JOIN degeneracy ON codon = ca UNION ALL SELECT i, j, n, substr(ca, k, 1), substr(cb, k, 1), d FROM met JOIN degeneracy ON codon = cb),
  sums AS (SELECT i, j, {", ".join(f"sum(CASE WHEN d = {k} {c} THEN n / 2.0 ELSE 0.0 END) AS {name}{k}" for k in (0, 2, 4) for name, c in (("l", ""), ("ts", "AND a || b IN ('TC', 'CT', 'AG', 'GA')"), ("tv", "AND a <> b AND a || b NOT IN ('TC', 'CT', 'AG', 'GA')")))} FROM sides GROUP BY i, j),
  parts AS (SELECT *, {", ".join(_class_terms(k) for k in (0, 2, 4))} FROM sums)
  SELECT i, j, round((l2 * a2 + l4 * (a4 + b4)) / (l2 / 3 + l4), 6) + 0.0 AS ds, round((l2 * b2 + l0 * (a0 + b0)) / (l2 * 2 / 3 + l0), 6) + 0.0 AS dn FROM parts"""

TREE = """nodes AS (
  SELECT CAST(0 AS BIGINT) AS node_id, CAST(NULL AS BIGINT) AS father_id, CAST(0 AS DOUBLE) AS branch_length, false AS is_tip
  UNION ALL SELECT r_regionkey + 1, 0, (r_regionkey + 1) / 10.0, false FROM region
  UNION ALL SELECT n_nationkey + 100, n_regionkey + 1, (n_nationkey % 7 + 1) / 20.0, false FROM nation
  UNION ALL SELECT 1000 + 2 * c_custkey, c_nationkey + 100, abs(c_acctbal) / 10000.0, true FROM customer
  UNION ALL SELECT 1001 + 2 * s_suppkey, s_nationkey + 100, abs(s_acctbal) / 10000.0, true FROM supplier)"""
PATHS = "RECURSIVE " + TREE + """, paths AS (
  SELECT node_id, node_id AS ancestor_id, 0 AS steps, CAST(0 AS DOUBLE) AS length FROM nodes
  UNION ALL SELECT p.node_id, n.father_id, p.steps + 1, p.length + n.branch_length FROM paths p JOIN nodes n ON n.node_id = p.ancestor_id WHERE n.father_id IS NOT NULL)"""
MET = PATHS + """, tip_pairs AS (SELECT DISTINCT 1000 + 2 * o_custkey AS a, 1001 + 2 * l_suppkey AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  common AS (SELECT a, b, x.ancestor_id, x.steps, x.length + y.length AS distance FROM tip_pairs JOIN paths x ON x.node_id = a JOIN paths y ON y.node_id = b AND y.ancestor_id = x.ancestor_id),
  mrca AS (SELECT a, b, arg_min(ancestor_id, steps) AS mrca, arg_min(distance, steps) AS distance FROM common GROUP BY a, b)"""
SPLITS = """grouped AS (SELECT l_orderkey AS tree_id, l_partkey % 3 AS g, bit_or(1 << (l_linenumber - 1)) AS bits FROM lineitem GROUP BY 1, 2),
  sided AS (SELECT DISTINCT tree_id, CASE WHEN bits & 1 = 1 THEN 127 - bits ELSE bits END AS bits FROM grouped),
  splits AS (SELECT tree_id, reverse(lpad(bin(bits), 7, '0')) AS split FROM sided WHERE bit_count(bits) BETWEEN 2 AND 5)"""
LNF = "lnf AS (SELECT o_orderkey % 3 AS tree_id, o_orderkey // 3 AS site, -ln(1 + o_totalprice / 1000) AS lnf FROM orders)"
VALUES = "vals AS (" + " UNION ALL ".join(f"SELECT '{p}' AS param, CAST(l_{p} AS DOUBLE) AS value FROM lineitem" for p in ("quantity", "extendedprice", "discount", "tax")) + "), placed AS (SELECT param, value, row_number() OVER (PARTITION BY param ORDER BY value) - 1 AS rank, count(*) OVER (PARTITION BY param) AS n FROM vals)"
PLACEMENTS = "candidates AS (SELECT l_orderkey AS placement_id, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_partkey AS edge_num, -l_extendedprice / 1e4 AS likelihood, -l_extendedprice * (1 - l_discount) / 1e4 AS marginal_like FROM lineitem)"
CLASSES = "classes AS (SELECT l_orderkey AS site, least(l_linenumber, 3) AS class, 0.5 / least(l_linenumber, 3) AS weight, -l_extendedprice / 5e4 AS lnf FROM lineitem)"
RHO = "rho_long AS (SELECT n_name AS grp, c_mktsegment AS region, avg(c_custkey % 7) AS rho, sqrt(sum(c_custkey % 7)) / count(*) AS rho_se FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"
