"""DuckDB versions of the fixtures, as common table expressions for the reference SQL."""

from __future__ import annotations

from checks.fixtures import ALL_SOURCES, LEXICON, RUNS, STOP_WORDS


def texts(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_NORM = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"


def norm(column: str) -> str:
    return _NORM.format(column)


def words_of(column: str) -> str:
    return f"CASE WHEN {column} = '' THEN 0 ELSE length({column}) - length(replace({column}, ' ', '')) + 1 END"


def byte(digest: str, position: int) -> str:
    return f"CAST('0x' || substr({digest}, {2 * position + 1}, 2) AS INTEGER)"


def side(train: float = 0.7, val: float = 0.15) -> str:
    a = f"CAST(floor(CAST(n AS DOUBLE) * CAST({train} AS DOUBLE)) AS BIGINT)"
    b = f"CAST(floor(CAST(n AS DOUBLE) * CAST({val} AS DOUBLE)) AS BIGINT)"
    return f"CASE WHEN r <= {a} THEN 'train' WHEN r <= {a} + {b} THEN 'val' ELSE 'test' END"


_CASES = ", ".join(f"max(text) FILTER (WHERE turn % 4 = {i}) AS t{i}" for i in range(4))
_DOCS = ", ".join(f"CASE WHEN doc_id % 4 = {i} THEN text END AS t{i}" for i in range(4))
_LONG = " UNION ALL ".join(
    f"SELECT family_id, source, 'T{i + 1}' AS label, {i} AS label_id, t{i} AS raw_text FROM fam" for i in range(4)
)
_ROW = f"""family_id || '__' || label AS id, family_id, source, text, label, label_id,
  CAST(length(text) AS INTEGER) AS text_len_char, CAST({words_of('text')} AS INTEGER) AS text_len_word"""
FIELDS = "id, family_id, source, text, label, label_id, text_len_char, text_len_word"
_RUNS = ", ".join(f"('{m}', CAST({s} AS BIGINT), {n})" for m, s, n in RUNS)
_BONUS = ", ".join(
    f"({byte('h', 2 + c)} + CASE WHEN label_id = {c} THEN 100 ELSE 0 END) / CAST(256 AS DOUBLE)" for c in range(4)
)


def noisy(key: str, noise) -> str:
    return (
        f"CASE WHEN {byte(f'md5({key})', 0)} < {noise} THEN {byte(f'md5({key})', 1)} % 4 ELSE label_id END"
    )


_CTES = {
    "chats": f"""SELECT conv_id || '.' || (turn // 4) AS idx,
      CASE conv_id % 3 WHEN 0 THEN 'mrpc' WHEN 1 THEN 'paws' ELSE 'hlpc' END AS source, {_CASES}
      FROM conversations GROUP BY conv_id, turn // 4""",
    "docs": f"SELECT CAST(doc_id AS VARCHAR) AS idx, lower(source) AS source, {_DOCS} FROM documents",
    "fam": """SELECT source || '_' || idx AS family_id, source, t0, t1, t2, t3
      FROM (SELECT * FROM chats UNION ALL SELECT * FROM docs) WHERE idx IS NOT NULL AND source <> ''""",
    "lng": _LONG,
    "nrm": f"SELECT family_id, source, label, label_id, raw_text, {norm('raw_text')} AS text FROM lng",
    "cls": f"""SELECT {_ROW}, CASE WHEN text IS NULL OR text = '' THEN 'null_or_blank'
      WHEN length(text) > 4000 THEN 'too_long' END AS drop_reason FROM nrm""",
    "alr": f"SELECT {_ROW} FROM nrm WHERE text <> ''",
    "mat": "SELECT * FROM alr WHERE text_len_char <= 4000",
    "rnk": """SELECT family_id, row_number() OVER (ORDER BY md5('42:' || family_id), family_id) AS r,
      count(*) OVER () AS n FROM (SELECT DISTINCT family_id FROM mat)""",
    "spl": f"SELECT mat.*, {side()} AS split FROM mat JOIN rnk USING (family_id)",
    "cor": """SELECT * FROM spl QUALIFY
      row_number() OVER (PARTITION BY split, label, text ORDER BY family_id, id, source) = 1""",
    "lbr": f"""SELECT 'doc_' || doc_id AS family_id, source, 'T' || (quality * 2 + toxic + 1) AS label,
      CAST(quality * 2 + toxic AS INTEGER) AS label_id, {norm('text')} AS text
      FROM documents JOIN labels USING (doc_id)""",
    "lbk": """SELECT family_id, row_number() OVER (ORDER BY md5('42:' || family_id), family_id) AS r,
      count(*) OVER () AS n FROM (SELECT DISTINCT 'doc_' || doc_id AS family_id FROM labels)""",
    "lab": f"SELECT {_ROW}, {side()} AS split FROM lbr JOIN lbk USING (family_id)",
    "run": f"SELECT * FROM (VALUES {_RUNS}) AS v(model_name, seed, noise)",
    "prh": """SELECT model_name, seed, noise, id, label_id, text_len_word, text_len_char,
      md5('p:' || model_name || ':' || seed || ':' || id) AS h FROM mat, run""",
    "prd": f"""SELECT model_name, seed, id, label_id AS y_true,
      CASE WHEN {byte('h', 0)} < noise THEN {byte('h', 1)} % 4 ELSE label_id END AS y_pred,
      [{_BONUS}] AS scores, text_len_word, text_len_char FROM prh""",
    "cel": "SELECT t.range AS y_true, p.range AS y_pred FROM range(4) t, range(4) p",
    "cnf": """SELECT r.model_name, r.seed, CAST(c.y_true AS INTEGER) AS y_true, CAST(c.y_pred AS INTEGER) AS y_pred,
      (SELECT count(*) FROM prd WHERE prd.model_name = r.model_name AND prd.seed = r.seed
        AND prd.y_true = c.y_true AND prd.y_pred = c.y_pred) AS n FROM run r, cel c""",
    "pcl": """SELECT model_name, seed, 'T' || (k + 1) AS label, tp, support, predicted,
      CASE WHEN predicted > 0 THEN tp / CAST(predicted AS DOUBLE) ELSE 0 END AS p,
      CASE WHEN support > 0 THEN tp / CAST(support AS DOUBLE) ELSE 0 END AS r,
      CASE WHEN support + predicted > 0 THEN 2 * tp / CAST(support + predicted AS DOUBLE) ELSE 0 END AS f
      FROM (SELECT model_name, seed, k.range AS k,
        CAST(sum(CASE WHEN y_true = k.range AND y_pred = k.range THEN n ELSE 0 END) AS BIGINT) AS tp,
        CAST(sum(CASE WHEN y_true = k.range THEN n ELSE 0 END) AS BIGINT) AS support,
        CAST(sum(CASE WHEN y_pred = k.range THEN n ELSE 0 END) AS BIGINT) AS predicted
        FROM cnf, range(4) k GROUP BY ALL)""",
    "smy": """SELECT model_name, seed, CAST(sum(support) AS BIGINT) AS n,
      sum(tp) / CAST(sum(support) AS DOUBLE) AS accuracy,
      avg(f) FILTER (WHERE support + predicted > 0) AS macro_f1,
      avg(p) FILTER (WHERE support + predicted > 0) AS precision_macro,
      avg(r) FILTER (WHERE support + predicted > 0) AS recall_macro,
      max(f) FILTER (WHERE label = 'T1') AS f1_T1, max(f) FILTER (WHERE label = 'T2') AS f1_T2,
      max(f) FILTER (WHERE label = 'T3') AS f1_T3, max(f) FILTER (WHERE label = 'T4') AS f1_T4
      FROM pcl GROUP BY ALL""",
    "sco": """SELECT model_name, seed, k.range AS class, y_true = k.range AS hit, scores[k.range + 1] AS s
      FROM prd, range(4) k""",
    "sct": """SELECT model_name, seed, class, s, count(*) FILTER (WHERE hit) AS pos,
      count(*) FILTER (WHERE NOT hit) AS neg FROM sco GROUP BY ALL""",
    "auc": """SELECT model_name, seed, class, sum(pos * (below + neg / 2.0)) / (sum(pos) * CAST(sum(neg) AS DOUBLE)) AS auroc
      FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model_name, seed, class ORDER BY s
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM sct) GROUP BY ALL""",
    "tim": """SELECT model_name, seed, CAST(sum(text_len_word) AS DOUBLE) / 1000 AS train_time_sec,
      CAST(count(*) AS DOUBLE) / 500 AS eval_time_sec, count(DISTINCT y_true) * 1001 AS num_params,
      CAST(sum(text_len_char) AS BIGINT) AS size_bytes FROM prd GROUP BY ALL""",
    "tok": r"""SELECT id, split, label, regexp_extract_all(lower(strip_accents(text)), '[\p{L}\p{N}_]{2,}') AS t FROM lab""",
    "grm": """SELECT id, split, unnest(list_concat(t, [t[i] || ' ' || t[i + 1] for i in range(1, len(t))])) AS term FROM tok""",
    "dtf": "SELECT id, split, term, count(*) AS tf FROM grm GROUP BY ALL",
    "vst": """SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM dtf WHERE split = 'train' GROUP BY term""",
    "voc": """SELECT term, tf, df, ln((1 + n) / (1 + CAST(df AS DOUBLE))) + 1 AS idf
      FROM vst, (SELECT CAST(count(*) AS DOUBLE) AS n FROM lab WHERE split = 'train')
      WHERE df >= 2 AND df <= n * CAST(0.95 AS DOUBLE) ORDER BY tf DESC, term LIMIT 20000""",
    "wgt": """SELECT id, split, term, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS weight
      FROM (SELECT id, split, term, (1 + ln(dtf.tf)) * idf AS x FROM dtf JOIN voc USING (term))""",
    "wst": """SELECT DISTINCT split, id, list_sort(list_distinct(string_split(lower(text), ' '))) AS s FROM spl
      WHERE split IN ('train', 'val')""",
    "wsg": """SELECT md5(array_to_string(s, ' ')) AS k, any_value(s) AS s, len(any_value(s)) AS size,
      count(*) FILTER (WHERE split = 'train') AS left_copies, count(*) FILTER (WHERE split = 'val') AS right_copies,
      min(id) FILTER (WHERE split = 'train') AS left_id, min(id) FILTER (WHERE split = 'val') AS right_id
      FROM wst GROUP BY 1""",
    "wsx": "SELECT k, size, left_copies, right_copies, unnest(s) AS w FROM wsg",
    "jac": """SELECT l.left_id, r.right_id, l.left_copies, r.right_copies, c / CAST(l.size + r.size - c AS DOUBLE) AS similarity
      FROM (SELECT a.k AS lk, b.k AS rk, count(*) AS c FROM wsx a JOIN wsx b USING (w)
        WHERE a.left_copies > 0 AND b.right_copies > 0 GROUP BY ALL) p
      JOIN wsg l ON l.k = lk JOIN wsg r ON r.k = rk
      WHERE c / CAST(l.size + r.size - c AS DOUBLE) > CAST(0.9 AS DOUBLE)""",
}


def _cosine(source: str, prefix: str, limit: str = "") -> dict[str, str]:
    """Brute-force cosine over all pairs of distinct texts that share a term."""
    p = prefix
    return {
        f"{p}txt": f"""SELECT md5(text) AS k, any_value(text) AS text, count(*) AS copies,
          count(*) FILTER (WHERE split = 'train') AS left_copies, count(*) FILTER (WHERE split = 'val') AS right_copies,
          min(id) FILTER (WHERE split = 'train') AS left_id, min(id) FILTER (WHERE split = 'val') AS right_id
          FROM {source} GROUP BY 1""",
        f"{p}tok": f"""SELECT k, copies, unnest(list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
          lambda w: w NOT IN ({texts(STOP_WORDS)}))) AS term FROM {p}txt""",
        f"{p}dtf": f"SELECT k, copies, term, count(*) AS tf FROM {p}tok GROUP BY ALL",
        f"{p}voc": f"""SELECT term, ln((1 + n) / (1 + CAST(sum(copies) AS DOUBLE))) + 1 AS idf
          FROM {p}dtf, (SELECT CAST(count(*) AS DOUBLE) AS n FROM {source}) GROUP BY term, n
          ORDER BY sum(tf * copies) DESC, term {limit}""",
        f"{p}wgt": f"""SELECT k, term, x / sqrt(sum(x * x) OVER (PARTITION BY k)) AS w
          FROM (SELECT k, term, tf * idf AS x FROM {p}dtf JOIN {p}voc USING (term))""",
        f"{p}prs": f"""SELECT l.left_id, r.right_id, l.left_copies, r.right_copies, c AS similarity
          FROM (SELECT a.k AS lk, b.k AS rk, sum(a.w * b.w) AS c
            FROM (SELECT * FROM {p}wgt WHERE k IN (SELECT k FROM {p}txt WHERE left_copies > 0)) a
            JOIN (SELECT * FROM {p}wgt WHERE k IN (SELECT k FROM {p}txt WHERE right_copies > 0)) b USING (term)
            GROUP BY ALL HAVING sum(a.w * b.w) > CAST(0.9 AS DOUBLE)) q
          JOIN {p}txt l ON l.k = lk JOIN {p}txt r ON r.k = rk""",
    }


_CTES["cin"] = "SELECT id, text, split FROM spl WHERE split IN ('train', 'val')"
_CTES.update(_cosine("cin", "c"))
_CTES["sin"] = """SELECT id, text, split FROM spl WHERE split IN ('train', 'val') QUALIFY
  row_number() OVER (PARTITION BY split ORDER BY md5('42:' || id), id) <= CASE split WHEN 'train' THEN 200 ELSE 100 END"""
_CTES.update(_cosine("sin", "s", "LIMIT 10000"))


def lexicon_swap(column: str) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in LEXICON.items())
    return f"array_to_string(list_transform(string_split({column}, ' '), lambda w: CASE w {cases} ELSE w END), ' ')"


def _needed(body: str) -> list[str]:
    import re

    wanted: set[str] = set()
    todo = [body]
    while todo:
        for name in set(re.findall(r"\b[a-z]{3,5}\b", todo.pop())) & _CTES.keys() - wanted:
            wanted.add(name)
            todo.append(_CTES[name])
    return [name for name in _CTES if name in wanted]


def sql(body: str) -> str:
    """The query with the table expressions it uses."""
    names = _needed(body)
    if not names:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in names) + "\n" + body


SOURCES_SQL = texts(ALL_SOURCES)
