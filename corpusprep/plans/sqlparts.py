"""SQL text shared by the DuckDB oracle statements.

The oracle statements restate each operator's semantics in plain SQL over
the driver's tables, so that an independent engine checks the Spark plans.
"""

from __future__ import annotations

from corpusprep.functions.text import WHITESPACE

SEED = 42
FRAC = 0.8

D = ("SELECT 'documents' AS workbook, lang AS sheet, doc_id AS row_idx, source, text "
     "FROM documents")
L = ("SELECT 'lang' AS workbook, 'b' || CAST(doc_id % 4 AS VARCHAR) AS sheet, doc_id AS row_idx, "
     "lang, text FROM documents")
V = ("SELECT 'chat' AS workbook, role AS sheet, conv_id * 1000 + turn AS row_idx, "
     "CAST(turn % 3 AS VARCHAR) AS turn_class, text FROM conversations")
Q = ("SELECT 'labelled' AS workbook, d.source AS sheet, d.doc_id AS row_idx, "
     "CAST(l.quality AS VARCHAR) AS quality, CAST(l.toxic AS VARCHAR) AS toxic, d.text "
     "FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
E = ("SELECT 'vec' AS workbook, 'e' || CAST(vec_id % 4 AS VARCHAR) AS sheet, vec_id AS row_idx, "
     "CAST(label AS VARCHAR) AS label, embedding FROM embeddings")
R = ("SELECT 'part' AS workbook, p_brand AS sheet, p_partkey AS row_idx, p_name, p_type, p_size, "
     "p_retailprice FROM part")


def strip(expr: str) -> str:
    ws = WHITESPACE.replace("'", "''")
    return f"trim({expr}, '{ws}')"


def tagged(cols: list[str]) -> str:
    parts = [f"'[{c.upper()}] ' || {strip(f'coalesce(CAST({c} AS VARCHAR), {chr(39)}nan{chr(39)})')}"
             for c in cols]
    return " || ' ' || ".join(parts)


def shuffle_key(row_idx: str = "row_idx", seed: int = SEED) -> str:
    return f"md5('{seed}:' || CAST({row_idx} AS VARCHAR))"


def split(src: str, label: str, frac: float = FRAC, seed: int = SEED) -> str:
    """Stratified split of ``src`` by ``label`` as a plain window query."""
    w = f"PARTITION BY workbook, sheet, {label}"
    return (
        f"SELECT s.*, CASE WHEN row_number() OVER ({w} ORDER BY {shuffle_key(seed=seed)}, row_idx) "
        f"<= greatest(1, floor(count(*) OVER ({w}) * CAST({frac!r} AS DOUBLE))) "
        f"THEN 'train' ELSE 'test' END AS split FROM ({src}) s WHERE {label} IS NOT NULL"
    )


def with_text(src: str, cols: list[str], name: str = "ctext") -> str:
    return f"SELECT s.*, {tagged(cols)} AS {name} FROM ({src}) s"


WORDS = r"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}]+')"


def words(x: str) -> str:
    return WORDS.format(x=x)


def nb_ctes(split_src: str, label: str, text: str = "ctext", test_text: str | None = None) -> str:
    """CTEs fitting multinomial NB (add-one) per group and scoring test rows.

    Defines ``lmap``, ``cls``, ``cnt`` and ``sc`` (row x class scores) and
    ``pred`` (best class, smaller id on ties, softmax confidence).
    """
    w = words(text)
    shown = f"{test_text} AS {text}" if test_text else text
    return f"""
s AS ({split_src}),
tr AS (SELECT workbook, sheet, CAST({label} AS VARCHAR) AS label, {text} FROM s WHERE split = 'train'),
cnt AS (SELECT workbook, sheet, label, token, count(*) AS cnt
        FROM (SELECT workbook, sheet, label, unnest({w}) AS token FROM tr) t GROUP BY workbook, sheet, label, token),
voc AS (SELECT workbook, sheet, count(DISTINCT token) AS vocab_size FROM cnt GROUP BY workbook, sheet),
tot AS (SELECT workbook, sheet, label, sum(cnt) AS total FROM cnt GROUP BY workbook, sheet, label),
docs AS (SELECT workbook, sheet, label, count(*) AS n_docs FROM tr GROUP BY workbook, sheet, label),
lmap AS (SELECT workbook, sheet, label,
                CAST(row_number() OVER (PARTITION BY workbook, sheet ORDER BY label) - 1 AS INTEGER) AS label_id
         FROM (SELECT DISTINCT workbook, sheet, label FROM tr WHERE label IS NOT NULL) x),
cls AS (SELECT d.workbook, d.sheet, d.label, m.label_id, d.n_docs, coalesce(t.total, 0) AS total,
               coalesce(v.vocab_size, 0) AS vocab_size,
               ln(d.n_docs / sum(d.n_docs) OVER (PARTITION BY d.workbook, d.sheet)) AS log_prior,
               ln(coalesce(t.total, 0) + 1.0 * coalesce(v.vocab_size, 0)) AS log_denom
        FROM docs d LEFT JOIN tot t ON d.workbook = t.workbook AND d.sheet = t.sheet AND d.label = t.label
        LEFT JOIN voc v ON d.workbook = v.workbook AND d.sheet = v.sheet
        JOIN lmap m ON d.workbook = m.workbook AND d.sheet = m.sheet AND d.label = m.label),
te AS (SELECT workbook, sheet, row_idx, CAST({label} AS VARCHAR) AS label, {shown} FROM s WHERE split = 'test'),
tf AS (SELECT workbook, sheet, row_idx, token, count(*) AS tf
       FROM (SELECT workbook, sheet, row_idx, unnest({w}) AS token FROM te) t GROUP BY workbook, sheet, row_idx, token),
known AS (SELECT tf.* FROM tf WHERE EXISTS (SELECT 1 FROM cnt c WHERE c.workbook = tf.workbook
          AND c.sheet = tf.sheet AND c.token = tf.token)),
nk AS (SELECT workbook, sheet, row_idx, sum(tf) AS n_known FROM known GROUP BY workbook, sheet, row_idx),
gain AS (SELECT k.workbook, k.sheet, k.row_idx, c.label, sum(k.tf * (ln(c.cnt + 1.0) - ln(1.0))) AS gain
         FROM known k JOIN cnt c ON k.workbook = c.workbook AND k.sheet = c.sheet AND k.token = c.token
         GROUP BY k.workbook, k.sheet, k.row_idx, c.label),
rws AS (SELECT te.workbook, te.sheet, te.row_idx, coalesce(nk.n_known, 0) AS n_known FROM te
        LEFT JOIN nk ON te.workbook = nk.workbook AND te.sheet = nk.sheet AND te.row_idx = nk.row_idx),
sc AS (SELECT r.workbook, r.sheet, r.row_idx, c.label, c.label_id,
              c.log_prior + coalesce(g.gain, 0) + r.n_known * (ln(1.0) - c.log_denom) AS score
       FROM rws r JOIN cls c ON r.workbook = c.workbook AND r.sheet = c.sheet
       LEFT JOIN gain g ON r.workbook = g.workbook AND r.sheet = g.sheet AND r.row_idx = g.row_idx
                       AND c.label = g.label),
ranked AS (SELECT sc.*, row_number() OVER (PARTITION BY workbook, sheet, row_idx ORDER BY score DESC, label_id) AS rn,
                  max(score) OVER (PARTITION BY workbook, sheet, row_idx) AS mx FROM sc),
pred AS (SELECT workbook, sheet, row_idx, max(CASE WHEN rn = 1 THEN label_id END) AS pred_id,
                max(CASE WHEN rn = 1 THEN label END) AS pred_label, 1.0 / sum(exp(score - mx)) AS confidence
         FROM ranked GROUP BY workbook, sheet, row_idx),
ev AS (SELECT te.workbook, te.sheet, te.row_idx, te.label, CAST(coalesce(m.label_id, -1) AS INTEGER) AS label_id,
              p.pred_id, p.pred_label, p.confidence
       FROM te LEFT JOIN lmap m ON te.workbook = m.workbook AND te.sheet = m.sheet AND te.label = m.label
       JOIN pred p ON te.workbook = p.workbook AND te.sheet = p.sheet AND te.row_idx = p.row_idx),
roles AS (SELECT workbook, sheet, label_id AS cls, 1 AS is_actual, CAST(label_id = pred_id AS INTEGER) AS hit FROM ev
          UNION ALL SELECT workbook, sheet, pred_id, 0, 0 FROM ev),
rep0 AS (SELECT workbook, sheet, cls, sum(is_actual) AS support, sum(1 - is_actual) AS n_pred, sum(hit) AS tp
         FROM roles GROUP BY workbook, sheet, cls),
rep AS (SELECT workbook, sheet, CAST(cls AS INTEGER) AS class_id,
               CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support FROM rep0),
repf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END
                AS f1 FROM rep)"""


def _split_ranges(name: str, start: str, runs: str, shortest: int) -> str:
    """A recursive CTE: difflib's matching blocks of the ranges ``start``. ``k``: characters of a block; a range without a
    common run of ``shortest`` characters is a ``leaf``. ``runs`` are those of equal characters, as long as they go."""
    i, end = "greatest(r.i, alo, blo + r.i - r.j)", "least(r.i + r.n, ahi, bhi + r.i - r.j)"

    def low(at: int, edge: str) -> str:
        return f"CASE WHEN best IS NULL OR side = 0 THEN {edge} WHEN side = 1 THEN best[{at}] - best[1] ELSE 0 END"

    def high(at: int, edge: str) -> str:
        return f"CASE WHEN best IS NULL OR side = 1 THEN {edge} WHEN side = 0 THEN best[{at}] ELSE 0 END"

    return f"""{name} AS (SELECT id, alo, ahi, blo, bhi, CAST(0 AS BIGINT) AS k, false AS leaf FROM {start}
  UNION ALL
  SELECT id, {low(2, 'alo')}, {high(2, 'ahi')}, {low(3, 'blo')}, {high(3, 'bhi')},
         CASE WHEN best IS NOT NULL AND side = 2 THEN -best[1] ELSE 0 END, best IS NULL
  FROM (SELECT q.id, alo, ahi, blo, bhi, min(CASE WHEN r.id IS NOT NULL THEN [{i} - {end}, {i}, {i} + r.j - r.i] END) AS best
        FROM {name} q LEFT JOIN {runs} r ON r.id = q.id AND {end} - {i} >= {shortest}
        WHERE NOT leaf AND alo < ahi AND blo < bhi GROUP BY q.id, alo, ahi, blo, bhi) x, (VALUES (0), (1), (2)) t(side)
  WHERE best IS NOT NULL OR side = 0)"""


def near(by: list[str], rows: str = "s") -> str:
    """CTEs of the recursive kind that end in ``near``: the (train, test) pairs of different texts ``ctext`` of ``rows``, within
    the groups ``by``, whose difflib ratio is 0.9 or more, with ``pairs``, the product of both multiplicities.

    Pairs that fail go by their lengths, their counts of common characters, the Levenshtein distance of the first or the
    last third (one of both has at most half of all unmatched characters, and cutting ``a`` at the same place costs no more
    than these once again), and that of the whole; other than ASCII characters count as one there. The matching blocks of
    the rest are found from runs of 8 equal characters first, then from all runs of what lies between.
    """
    k = "".join(f"{c}, " for c in by)
    ak = "".join(f"a.{c}, " for c in by)
    on = "".join(f"a.{c} IS NOT DISTINCT FROM b.{c} AND " for c in by)
    counts = "list_transform(string_split('etaoinshrdlucmfpvgbqéèüñó ', ''), lambda c: length(ctext) - length(replace(ctext, c, '')))"
    common = "list_sum(list_transform(list_zip(a.counts, b.counts), lambda x: least(x[1], x[2])))"
    others = "least(a.len - list_sum(a.counts), b.len - list_sum(b.counts))"
    return f"""
tt AS (SELECT {k}split, ctext, length(ctext) AS len, count(*) AS mult, {counts} AS counts,
              regexp_replace(ctext, '[^\x01-\x7f]', chr(1), 'g') AS plain
       FROM {rows} WHERE ctext IS NOT NULL GROUP BY {k}split, ctext),
band AS MATERIALIZED (
  SELECT {ak}a.ctext AS a, b.ctext AS b, a.len AS la, b.len AS lb, a.mult * b.mult AS pairs, a.plain AS pa, b.plain AS pb,
         CAST(floor(0.1 * (a.len + b.len) + 1e-9) AS INTEGER) AS slack, CAST(ceil(least(a.len, b.len) / 3) AS INTEGER) AS third,
         row_number() OVER () AS id
  FROM tt a JOIN tt b ON {on}a.split = 'train' AND b.split = 'test' AND a.ctext <> b.ctext
    AND 2 * least(a.len, b.len) >= 0.9 * (a.len + b.len) - 1e-9 AND {common} + {others} >= 0.9 * (a.len + b.len) / 2 - 1e-9),
cand AS MATERIALIZED (
  SELECT * FROM band WHERE (levenshtein(left(pa, third), left(pb, third)) <= slack
    OR levenshtein(right(pa, third), right(pb, third)) <= slack) AND levenshtein(pa, pb) <= slack),
ca AS MATERIALIZED (SELECT id, unnest(string_split(a, '')) AS c, generate_subscripts(string_split(a, ''), 1) AS i FROM cand),
cb AS MATERIALIZED (SELECT id, unnest(string_split(b, '')) AS c, generate_subscripts(string_split(b, ''), 1) AS j FROM cand),
ga AS (SELECT id, i, string_agg(c, '') OVER (PARTITION BY id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS g FROM ca),
gb AS (SELECT id, j, string_agg(c, '') OVER (PARTITION BY id ORDER BY j ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS g FROM cb),
e8 AS (SELECT ga.id, i, j, i - row_number() OVER (PARTITION BY ga.id, i - j ORDER BY i) AS island
       FROM ga JOIN gb ON ga.id = gb.id AND ga.g = gb.g WHERE length(ga.g) = 8),
long8 AS MATERIALIZED (SELECT id, min(i) AS i, min(j) AS j, count(*) + 7 AS n FROM e8 GROUP BY id, i - j, island),
whole AS (SELECT id, 1 AS alo, la + 1 AS ahi, 1 AS blo, lb + 1 AS bhi FROM cand),
{_split_ranges('coarse', 'whole', 'long8', 8)},
leaves AS MATERIALIZED (SELECT row_number() OVER () AS id, id AS pair, alo, ahi, blo, bhi FROM coarse WHERE leaf),
e1 AS (SELECT l.id, i, j, i - row_number() OVER (PARTITION BY l.id, i - j ORDER BY i) AS island
       FROM leaves l JOIN ca ON ca.id = l.pair AND i >= alo AND i < ahi JOIN cb ON cb.id = l.pair AND j >= blo AND j < bhi AND ca.c = cb.c),
short AS MATERIALIZED (SELECT id, min(i) AS i, min(j) AS j, count(*) AS n FROM e1 GROUP BY id, i - j, island),
{_split_ranges('fine', 'leaves', 'short', 1)},
m AS (SELECT id, sum(k) AS k FROM (SELECT id, k FROM coarse UNION ALL SELECT l.pair, f.k FROM fine f JOIN leaves l ON l.id = f.id) x GROUP BY id),
near AS (SELECT {k}a, b, pairs, 2.0 * m.k / (la + lb) AS similarity FROM cand JOIN m ON m.id = cand.id WHERE 2.0 * m.k / (la + lb) >= 0.9)"""
