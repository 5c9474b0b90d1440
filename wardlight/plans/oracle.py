"""The same queries in SQL, over the same tables, for an independent engine."""

from __future__ import annotations

# The item code of each event type and parity.
_ITEMS = (
    "WHEN 'view_0' THEN 220052 WHEN 'view_1' THEN 456 WHEN 'click_0' THEN 198 WHEN 'click_1' THEN 646 "
    "WHEN 'purchase_0' THEN 50912 WHEN 'purchase_1' THEN 50885 WHEN 'signup_0' THEN 51265 "
    "WHEN 'signup_1' THEN 50821 WHEN 'error_0' THEN 50816"
)

# Views and intermediate results; each may use the ones before it.
_CTES: dict[str, str] = {
    "px_chart": f"""
        SELECT stay AS subject_id, stay AS hadm_id, stay AS icustay_id, event_id, ts AS charttime,
            CASE code {_ITEMS} ELSE 0 END AS itemid,
            CASE WHEN code IN ('view_0', 'view_1') THEN 60::DOUBLE + value / 2::DOUBLE
                 WHEN code = 'click_0' THEN 15::DOUBLE - floor(value / 25::DOUBLE)
                 WHEN code = 'click_1' THEN 100::DOUBLE - value / 20::DOUBLE
                 WHEN code = 'purchase_0' THEN value / 30::DOUBLE
                 WHEN code = 'purchase_1' THEN value / 20::DOUBLE
                 WHEN code = 'signup_0' THEN 20::DOUBLE + value * 4::DOUBLE
                 WHEN code = 'signup_1' THEN 60::DOUBLE + value
                 WHEN code = 'error_0' THEN 21::DOUBLE + k * 0.3::DOUBLE
                 ELSE value END AS valuenum,
            CASE k % 3 WHEN 0 THEN 'kPa' WHEN 1 THEN 'umol/L' END AS valueuom,
            CASE WHEN k = 7 THEN 1 WHEN k >= 50 THEN 0 END AS error,
            CASE k % 10 WHEN 0 THEN 'abnormal' WHEN 1 THEN 'delta' WHEN 2 THEN 'normal' END AS flag
        FROM (
            SELECT *, user_id // 15 AS stay, event_type || '_' || (k % 2) AS code
            FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)
        )""",
    "codes": """
        SELECT * FROM (VALUES (220052, 'map', 'vital'), (456, 'map', 'vital'), (198, 'gcs', 'vital'),
            (646, 'spo2', 'vital'), (50912, 'creatinine', 'lab'), (50885, 'bilirubin', 'lab'),
            (51265, 'platelet', 'lab'), (50821, 'pao2', 'lab'), (50816, 'fio2', 'lab')) AS c(itemid, name, kind)""",
    "px_icu": """
        SELECT user_id // 15 AS icustay_id, user_id // 15 AS hadm_id, min(ts) AS intime, max(ts) AS outtime
        FROM events GROUP BY ALL""",
    "vitals": """
        SELECT subject_id, hadm_id, icustay_id, date_trunc('hour', charttime) AS hour_bucket, name AS vital_name,
            avg(valuenum) AS mean_val, min(valuenum) AS min_val, max(valuenum) AS max_val,
            count(valuenum) AS measurement_count
        FROM px_chart JOIN codes USING (itemid)
        WHERE kind = 'vital' AND (error IS NULL OR error <> 1) AND icustay_id IS NOT NULL AND valuenum IS NOT NULL
        GROUP BY ALL""",
    "labs": """
        SELECT px_chart.*, name AS lab_name,
            CASE WHEN flag IS NOT NULL THEN CAST(flag IN ('abnormal', 'delta') AS INTEGER) END AS is_abnormal
        FROM px_chart JOIN codes USING (itemid)
        WHERE kind = 'lab' AND hadm_id IS NOT NULL AND valuenum IS NOT NULL""",
    "spine": """
        SELECT icustay_id, hadm_id, intime + to_hours(k) AS score_window_start,
            intime + to_hours(k + 24) AS score_window_end
        FROM (SELECT *, unnest(generate_series(0, last)) AS k
              FROM (SELECT *, (epoch_us(outtime) - epoch_us(intime)) // 3600000000 - 24 AS last FROM px_icu)
              WHERE last >= 0)""",
    "vital_worst": """
        SELECT s.icustay_id, s.score_window_end,
            min(CASE WHEN vital_name = 'map' THEN mean_val END) AS "map",
            min(CASE WHEN vital_name = 'gcs' THEN mean_val END) AS gcs,
            min(CASE WHEN vital_name = 'spo2' THEN mean_val END) AS spo2
        FROM spine s JOIN vitals v ON v.icustay_id = s.icustay_id
            AND v.hour_bucket >= s.score_window_start AND v.hour_bucket < s.score_window_end
        GROUP BY ALL""",
    "lab_worst": """
        SELECT s.icustay_id, s.score_window_end,
            max(CASE WHEN lab_name = 'creatinine' THEN valuenum END) AS creatinine,
            max(CASE WHEN lab_name = 'bilirubin' THEN valuenum END) AS bilirubin,
            min(CASE WHEN lab_name = 'platelet' THEN valuenum END) AS platelet,
            min(CASE WHEN lab_name = 'pao2' THEN valuenum END) AS pao2,
            min(CASE WHEN lab_name = 'fio2' THEN valuenum END) AS fio2
        FROM spine s JOIN labs l ON l.hadm_id = s.hadm_id
            AND l.charttime >= s.score_window_start AND l.charttime < s.score_window_end
        GROUP BY ALL""",
    "features": """
        SELECT s.icustay_id, s.score_window_end, s.score_window_start, "map", gcs, spo2,
            creatinine, bilirubin, platelet, pao2, fio2,
            CASE WHEN fio2 > 0 THEN pao2 / (fio2 / 100::DOUBLE) END AS pao2_fio2
        FROM spine s LEFT JOIN vital_worst USING (icustay_id, score_window_end)
            LEFT JOIN lab_worst USING (icustay_id, score_window_end)""",
    "ladders": """
        SELECT *,
            CASE WHEN pao2_fio2 >= 400 THEN 0 WHEN pao2_fio2 >= 300 THEN 1 WHEN pao2_fio2 >= 200 THEN 2
                 WHEN pao2_fio2 >= 100 THEN 3 ELSE 4 END AS sofa_resp,
            CASE WHEN platelet >= 150 THEN 0 WHEN platelet >= 100 THEN 1 WHEN platelet >= 50 THEN 2
                 WHEN platelet >= 20 THEN 3 ELSE 4 END AS sofa_coag,
            CASE WHEN bilirubin < 1.2::DOUBLE THEN 0 WHEN bilirubin < 2 THEN 1 WHEN bilirubin < 6 THEN 2
                 WHEN bilirubin < 12 THEN 3 ELSE 4 END AS sofa_liver,
            CASE WHEN "map" >= 70 THEN 0 ELSE 1 END AS sofa_cardio,
            CASE WHEN gcs = 15 THEN 0 WHEN gcs >= 13 THEN 1 WHEN gcs >= 10 THEN 2
                 WHEN gcs >= 6 THEN 3 ELSE 4 END AS sofa_cns,
            CASE WHEN creatinine < 1.2::DOUBLE THEN 0 WHEN creatinine < 2 THEN 1
                 WHEN creatinine < 3.5::DOUBLE THEN 2 WHEN creatinine < 5 THEN 3 ELSE 4 END AS sofa_renal,
            (pao2_fio2 IS NULL)::INTEGER + (platelet IS NULL)::INTEGER + (bilirubin IS NULL)::INTEGER
                + ("map" IS NULL)::INTEGER + (gcs IS NULL)::INTEGER + (creatinine IS NULL)::INTEGER AS n_missing
        FROM features""",
    "scores": """
        SELECT *, CASE WHEN sofa_total <= 5 THEN 'low' WHEN sofa_total <= 9 THEN 'moderate'
                       WHEN sofa_total <= 12 THEN 'high' ELSE 'critical' END AS risk_tier,
            CAST(sofa_total >= 2 AS INTEGER) AS sepsis_alert
        FROM (SELECT *, sofa_resp + sofa_coag + sofa_liver + sofa_cardio + sofa_cns + sofa_renal AS sofa_total
              FROM ladders)""",
    "alerts": """
        SELECT icustay_id, score_window_end, sofa_total, risk_tier,
            sofa_resp, sofa_coag, sofa_liver, sofa_cardio, sofa_cns, sofa_renal
        FROM scores WHERE sepsis_alert = 1
        QUALIFY row_number() OVER (PARTITION BY icustay_id ORDER BY score_window_end DESC) = 1""",
    "px_notes": """
        SELECT doc_id AS note_id, source AS subject_id, doc_id % 20 AS hadm_id, lang AS category,
            TIMESTAMP '2024-01-01' + to_days((doc_id % 7)::INTEGER) AS charttime,
            CASE WHEN doc_id % 11 <> 0
                 THEN TIMESTAMP '2024-01-01' + to_days((doc_id % 7)::INTEGER) + to_hours(doc_id * 13 % 97)
                 END AS storetime,
            CASE WHEN doc_id % 17 = 0 THEN 1 END AS iserror, text
        FROM documents""",
    "clean_notes": r"""
        SELECT *, CAST(len(regexp_split_to_array(text, '\s+')) AS INTEGER) AS word_count
        FROM px_notes WHERE (iserror IS NULL OR iserror <> 1) AND text IS NOT NULL AND length(text) > 50
        QUALIFY row_number() OVER (PARTITION BY subject_id, hadm_id, category, charttime
                                   ORDER BY storetime DESC NULLS LAST, note_id) = 1""",
    "px_queue": """
        SELECT note_id AS queue_id, hadm_id, CASE WHEN note_id % 13 <> 0 THEN charttime END AS charttime,
            text AS note_text, CASE WHEN note_id % 3 <> 0 THEN charttime END AS embedded_at
        FROM px_notes""",
    "px_done": """
        SELECT note_id, sha256(CASE WHEN category = 'de' THEN text || '*' ELSE text END) AS content_hash
        FROM px_notes WHERE category <> 'en'""",
    "fresh_notes": """
        SELECT n.* FROM (SELECT *, sha256(text) AS content_hash FROM px_notes) n
        WHERE NOT EXISTS (SELECT 1 FROM px_done d
                          WHERE d.note_id = n.note_id AND d.content_hash = n.content_hash)""",
    "px_vectors": """
        SELECT vec_id AS note_id, label::BIGINT AS icustay_id, lang AS note_category,
            coalesce(text, 'chunk ' || vec_id) AS chunk_text, embedding::DOUBLE[] AS v
        FROM embeddings LEFT JOIN documents ON vec_id = doc_id""",
    "cells": """
        SELECT vec_id, label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x
        FROM embeddings""",
    "questions": """
        SELECT label::BIGINT AS question_id, list(m ORDER BY pos) AS v,
            'Which stays are like group ' || label || '?' AS question,
            CASE label % 3 WHEN 1 THEN ['high', 'critical'] WHEN 2 THEN ['moderate']
                 ELSE ['low', 'moderate', 'high', 'critical'] END AS tiers,
            CASE WHEN label % 5 <> 0 THEN CASE WHEN label % 7 = 3 THEN 40 ELSE label + 3 END END AS top_k
        FROM (SELECT label, pos, avg(x) AS m FROM cells GROUP BY ALL) GROUP BY label""",
    "risk": """
        SELECT question_id, top_k, a.*,
            row_number() OVER (PARTITION BY question_id ORDER BY sofa_total DESC, icustay_id)::INTEGER AS patient_rank
        FROM questions JOIN alerts a ON list_contains(tiers, a.risk_tier)
        QUALIFY patient_rank <= coalesce(top_k, 10)""",
    "found": """
        SELECT r.question_id, c.*,
            row_number() OVER (PARTITION BY r.question_id
                ORDER BY round(list_cosine_similarity(c.v, q.v), 9) DESC, note_id)::INTEGER AS rank
        FROM risk r JOIN questions q USING (question_id) JOIN px_vectors c ON c.icustay_id = r.icustay_id
        QUALIFY rank <= least(2 * max(coalesce(r.top_k, 10)) OVER (PARTITION BY r.question_id), 20)""",
    "support": """
        SELECT question_id, icustay_id, substring(chunk_text, 1, 300) AS note,
            row_number() OVER (PARTITION BY question_id, icustay_id ORDER BY rank)::INTEGER AS note_rank
        FROM found QUALIFY note_rank <= 3""",
    "patient_text": """
        SELECT question_id, string_agg(
            'Patient ICU Stay: ' || icustay_id || chr(10) ||
            '  SOFA Total: ' || sofa_total || ' (' || upper(risk_tier) || ' risk)' || chr(10) ||
            '  Sub-scores — Respiratory: ' || sofa_resp || ', Coagulation: ' || sofa_coag ||
            ', Liver: ' || sofa_liver || ', Cardiovascular: ' || sofa_cardio ||
            ', CNS: ' || sofa_cns || ', Renal: ' || sofa_renal || chr(10) ||
            '  Score window end: ' || strftime(score_window_end, '%Y-%m-%d %H:%M:%S') ||
            CASE WHEN epoch_us(score_window_end) % 1000000 > 0 THEN strftime(score_window_end, '.%f') ELSE '' END ||
            '+00:00', chr(10) || chr(10) ORDER BY patient_rank) AS patients_section
        FROM risk GROUP BY question_id""",
    "excerpt_text": """
        SELECT question_id, string_agg(
            '[Excerpt ' || rank || ' — ICU Stay ' || icustay_id || ', Category: ' ||
            coalesce(note_category, 'unknown') || ']' || chr(10) || substring(chunk_text, 1, 600),
            chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS notes_section
        FROM found WHERE rank <= 8 GROUP BY question_id""",
    "px_metrics": """
        SELECT *, tokens_in + tokens_out AS tokens_used,
            (tokens_in * CASE model WHEN 'claude-opus-4-6' THEN 15.0::DOUBLE WHEN 'claude-sonnet-4-6' THEN 3.0::DOUBLE
                 WHEN 'gpt-4o' THEN 5.0::DOUBLE WHEN 'gpt-4o-mini' THEN 0.15::DOUBLE ELSE 5.0::DOUBLE END
             + tokens_out * CASE model WHEN 'claude-opus-4-6' THEN 75.0::DOUBLE WHEN 'claude-sonnet-4-6' THEN 15.0::DOUBLE
                 WHEN 'gpt-4o' THEN 15.0::DOUBLE WHEN 'gpt-4o-mini' THEN 0.6::DOUBLE ELSE 15.0::DOUBLE END
            ) / 1000000::DOUBLE AS estimated_cost_usd
        FROM (
            SELECT event_id AS query_id, event_type AS provider, value * 100::DOUBLE AS latency_ms, ts AS queried_at,
                CASE k % 5 WHEN 0 THEN 'claude-opus-4-6' WHEN 1 THEN 'claude-sonnet-4-6' WHEN 2 THEN 'gpt-4o'
                     WHEN 3 THEN 'gpt-4o-mini' ELSE 'other-model' END AS model,
                (k + 100)::BIGINT AS tokens_in, (k + 10)::BIGINT AS tokens_out
            FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)
        )""",
    "recent": """
        SELECT * FROM px_metrics WHERE queried_at >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS""",
}

_BOUNDS = (0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 30.0, 60.0)


def _q(ctes: str, body: str) -> str:
    names = ctes.split()
    if not names:
        return body.strip()
    parts = [f"{name} AS ({_CTES[name].strip()})" for name in _CTES if name in names]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


_CHART = "px_chart codes"
_SCORES = "px_chart codes px_icu vitals labs spine vital_worst lab_worst features ladders scores"
_ALERTS = _SCORES + " alerts"
_RISK = _ALERTS + " cells questions risk"
_FOUND = _RISK + " px_vectors found"


def _chunk_ctes(source: str, name: str, size: int = 1600, step: int = 1280) -> str:
    """Sections at line starts with The/And/Of, then overlapping windows, as CTEs.

    A marker character is put before every header and the text is split there.
    """
    return rf"""
        {name}_parts AS (
            SELECT note_id, p, generate_subscripts(p, 1) AS i, unnest(p) AS body
            FROM (SELECT note_id, string_split(regexp_replace(text, '(?im)^(The|And|Of)', chr(1) || '\1', 'g'), chr(1)) AS p
                  FROM {source})),
        {name}_sections AS (
            SELECT note_id, i, regexp_replace(body, '^\s+|\s+$', '', 'g') AS x,
                coalesce(sum(length(body)) OVER (PARTITION BY note_id ORDER BY i
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                + length(body) - length(regexp_replace(body, '^\s+', '')) AS section_start
            FROM {name}_parts),
        {name}_windows AS (
            SELECT *, substring(x, w * {step} + 1, {size}) AS raw
            FROM (SELECT *, unnest(generate_series(0, greatest(CAST(ceil((length(x) - {size}) / {step}.0) AS BIGINT), 0))) AS w
                  FROM {name}_sections WHERE x <> '')),
        {name} AS (
            SELECT note_id, (row_number() OVER (PARTITION BY note_id ORDER BY i, w) - 1)::INTEGER AS chunk_index,
                (section_start + w * {step} + length(raw) - length(regexp_replace(raw, '^\s+', '')))::INTEGER AS char_start,
                regexp_replace(raw, '^\s+|\s+$', '', 'g') AS chunk_text
            FROM {name}_windows WHERE regexp_replace(raw, '^\s+|\s+$', '', 'g') <> '')"""


def _with_chunks(ctes: str, chunks: list[tuple[str, str]], body: str, extra: str = "") -> str:
    parts = [f"{name} AS ({_CTES[name].strip()})" for name in _CTES if name in ctes.split()]
    if extra:
        parts.append(extra.strip())
    parts += [_chunk_ctes(source, name).strip() for source, name in chunks]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def _usage(source: str) -> str:
    return f"""
        SELECT provider, count(*) AS total_queries, round(avg(latency_ms), 6) AS avg_latency_ms,
            round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms,
            sum(tokens_used)::BIGINT AS total_tokens, round(sum(estimated_cost_usd), 8) AS total_cost_usd
        FROM {source} GROUP BY provider"""


def _le_columns() -> str:
    cells = [f"count(*) FILTER (latency_ms / 1000::DOUBLE <= {b}) AS le{i}" for i, b in enumerate(_BOUNDS)]
    return ", ".join(cells) + ", count(*) AS n"


def _quantile(q: float, places: int = 6) -> str:
    arms = []
    for i, bound in enumerate(_BOUNDS):
        low, before = (_BOUNDS[i - 1], f"le{i - 1}") if i else (0.0, "0")
        arms.append(
            f"WHEN le{i} >= {q}::DOUBLE * n THEN {low}::DOUBLE + {bound - low}::DOUBLE"
            f" * (({q}::DOUBLE * n - {before}) / (le{i} - {before}))"
        )
    return f"round(CASE {' '.join(arms)} ELSE {_BOUNDS[-1]}::DOUBLE END, {places})"


def _status(value: str, yellow: float, red: float) -> str:
    return f"CASE WHEN {value} >= {red} THEN 'red' WHEN {value} >= {yellow} THEN 'yellow' ELSE 'green' END"


_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_SHOWN_SCORES = """icustay_id, score_window_end, score_window_start, round("map", 6) AS "map", round(gcs, 6) AS gcs,
            round(spo2, 6) AS spo2, round(creatinine, 6) AS creatinine, round(bilirubin, 6) AS bilirubin,
            round(platelet, 6) AS platelet, round(pao2, 6) AS pao2, round(fio2, 6) AS fio2,
            round(pao2_fio2, 6) AS pao2_fio2, sofa_resp, sofa_coag, sofa_liver, sofa_cardio, sofa_cns, sofa_renal,
            n_missing, sofa_total, risk_tier, sepsis_alert"""

_VITAL_STREAM = """
        SELECT icustay_id, name AS vital_name, date_trunc('hour', charttime) AS hour_bucket,
            avg(valuenum) AS mean_val, min(valuenum) AS min_val, max(valuenum) AS max_val,
            count(*) AS measurement_count
        FROM px_chart JOIN codes USING (itemid)
        WHERE kind = 'vital' AND (error IS NULL OR error <> 1) GROUP BY ALL"""



def _vectors(source: str, keys: str, text: str, dim: int = 256) -> str:
    """Unit vectors of term counts: a term's position is its md5 modulo the length."""
    return rf"""
        words AS (SELECT {keys}, unnest(regexp_extract_all(lower({text}), '[^\x09-\x0D\x20]+')) AS w FROM {source}),
        counts AS (SELECT {keys}, (CAST('0x' || substr(md5(w), 1, 8) AS UBIGINT) % {dim})::INTEGER AS pos, count(*)::DOUBLE AS n
                   FROM words GROUP BY ALL),
        lengths AS (SELECT {keys}, sqrt(sum(n * n)) AS size, sum(n)::BIGINT AS terms FROM counts GROUP BY ALL),
        vec AS MATERIALIZED (
            SELECT {keys}, any_value(terms) AS terms, list(coalesce(n / size, 0)::FLOAT::DOUBLE ORDER BY pos) AS v
            FROM (SELECT {keys}, range::INTEGER AS pos FROM {source}, range({dim})) LEFT JOIN counts USING ({keys}, pos)
                LEFT JOIN lengths USING ({keys}) GROUP BY {keys}),
        shown AS (
            SELECT *, md5('[' || array_to_string(list_transform(v, lambda x: format('{{:.8f}}', x)), ',') || ']') AS vector_md5,
                round(sqrt(list_dot_product(v, v)), 4) AS length FROM vec)"""


def _ann_cells(iterations: int = 6, probes: int = 8, most: int = 512) -> str:
    """Spherical k-means from the first vectors by digest of their key, then the nearest cells of each question."""
    unit = "list_transform({0}, lambda x: x / sqrt(list_dot_product({0}, {0})))"
    parts = [
        f"""unit AS MATERIALIZED (
            SELECT note_id, v, {unit.format("v")} AS u,
                row_number() OVER (ORDER BY md5(note_id || '-0'), note_id) - 1 AS i FROM px_vectors)""",
        f"c0 AS MATERIALIZED (SELECT i AS cell, u AS c FROM unit WHERE i < (SELECT greatest(1, least({most}, floor(sqrt(count(*))))) FROM unit))",
    ]
    dealt = """a{0} AS MATERIALIZED (
            SELECT note_id, v, u, cell FROM unit, c{0}
            QUALIFY row_number() OVER (PARTITION BY note_id ORDER BY round(list_dot_product(u, c), 9) DESC, cell) = 1)"""
    for t in range(iterations):
        parts += [
            dealt.format(t),
            f"""s{t} AS MATERIALIZED (
            SELECT cell, list(x ORDER BY pos) AS m FROM (
                SELECT cell, pos, sum(x) AS x FROM (
                    SELECT cell, generate_subscripts(u, 1) AS pos, unnest(u) AS x FROM a{t}) GROUP BY ALL)
            GROUP BY cell)""",
            f"c{t + 1} AS MATERIALIZED (SELECT cell, coalesce({unit.format('m')}, c) AS c FROM c{t} LEFT JOIN s{t} USING (cell))",
        ]
    parts += [
        dealt.format(iterations),
        f"""near AS (
            SELECT question_id, v, cell FROM (SELECT question_id, v, {unit.format("v")} AS u FROM questions),
                (SELECT * FROM c{iterations} WHERE cell IN (SELECT cell FROM a{iterations}))
            QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY round(list_dot_product(u, c), 9) DESC, cell) <= {probes})""",
    ]
    body = f"""SELECT question_id, note_id, round(s, 6) AS cosine_similarity,
            row_number() OVER (PARTITION BY question_id ORDER BY round(s, 9) DESC, note_id)::INTEGER AS rank
        FROM (SELECT question_id, note_id, list_cosine_similarity(a.v, n.v) AS s FROM near n JOIN a{iterations} a USING (cell))
        QUALIFY rank <= 10"""
    return _q("px_vectors cells questions", ", " + ",\n".join(parts) + "\n" + body)


# The system message.
_SYSTEM = """You are a critical care clinical decision support assistant.  Your role is to
analyse ICU patient data and identify patients at elevated risk of sepsis
within the next 6 hours.

Guidelines:
- Base your assessment on the provided SOFA scores and retrieved clinical notes.
- Be concise and clinician-friendly: use medical terminology, avoid hedging.
- For each high-risk patient, give a brief rationale (2-3 sentences) referencing
  specific lab values, vital trends, or note findings.
- Rank patients from highest to lowest risk.
- If data is insufficient to assess a patient, say so clearly rather than guessing.
- Do not fabricate clinical details not present in the provided context.
"""

# The wording of the prompt.
_PROMPTS = """SELECT question_id, 'Clinician Query: ' || question || chr(10) || chr(10) || 'Retrieved Timestamp: ' ||
        strftime((SELECT max(ts) FROM events), '%Y-%m-%d %H:%M UTC') || chr(10) || chr(10) ||
        '─── SOFA Alert Data ───────────────────────────────────────────────' || chr(10) ||
        coalesce(patients_section, 'No patients currently flagged.') || chr(10) || chr(10) ||
        '─── Retrieved Clinical Notes ──────────────────────────────────────' || chr(10) ||
        coalesce(notes_section, 'No clinical notes retrieved.') || chr(10) || chr(10) ||
        '─── Task ───────────────────────────────────────────────────────────' || chr(10) ||
        'Based on the above data, provide a ranked sepsis risk assessment.' || chr(10) ||
        'For each patient, include:' || chr(10) ||
        '1. Risk level and primary clinical drivers' || chr(10) ||
        '2. Organ systems of greatest concern' || chr(10) ||
        '3. Recommended immediate monitoring actions' || chr(10) || chr(10) ||
        'Format your response as a structured list, one entry per patient.' AS prompt
    FROM questions LEFT JOIN patient_text USING (question_id) LEFT JOIN excerpt_text USING (question_id)"""

_SHOWN_VECTORS = " SELECT note_id, chunk_index, 256 AS dims, coalesce(terms, 0) AS terms, length, vector_md5 FROM shown"
_CHUNK_VECTORS = """ SELECT note_id, chunk_index, char_start, 256 AS dims, length(chunk_text)::INTEGER AS n_chars, vector_md5
        FROM shown JOIN c USING (note_id, chunk_index)"""

_ADJUSTED_CHART = """
        SELECT subject_id, hadm_id, icustay_id, event_id, charttime, itemid, value_std AS valuenum, valueuom, error, flag
        FROM (
            SELECT *, quantile_cont(value_std, 0.25) OVER (PARTITION BY name) AS q1,
                quantile_cont(value_std, 0.75) OVER (PARTITION BY name) AS q3
            FROM (
                SELECT *, CASE WHEN name IN ('map', 'pao2') AND valueuom = 'kPa' THEN valuenum * 7.50062::DOUBLE
                       WHEN name = 'creatinine' AND valueuom = 'umol/L' THEN valuenum * (1::DOUBLE / 88.42::DOUBLE)
                       WHEN name = 'bilirubin' AND valueuom = 'umol/L' THEN valuenum * (1::DOUBLE / 17.104::DOUBLE)
                       ELSE valuenum END AS value_std
                FROM plain_chart JOIN codes USING (itemid)
                WHERE event_id % 37 <> 0 AND (error IS NULL OR error <> 1)))
        WHERE value_std BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)"""


def _adjusted(body: str) -> str:
    """As _q over the scores, with the chart rows in common units and without outliers."""
    parts = [f"plain_chart AS ({_CTES['px_chart'].strip()})", f"codes AS ({_CTES['codes'].strip()})"]
    parts.append(f"px_chart AS MATERIALIZED ({_ADJUSTED_CHART.strip()})")
    parts += [f"{n} AS ({_CTES[n].strip()})" for n in _CTES if n in _SCORES.split() and n not in ("px_chart", "codes")]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


ORACLE: dict[str, str] = {
    "csv_cast_bronze": """
        SELECT event_id::VARCHAR AS row_id, (user_id // 15)::INTEGER AS icustay_id,
            date_trunc('second', ts) AS charttime,
            CASE WHEN k <> 13 THEN round(value, 6) END AS valuenum,
            CASE WHEN k >= 50 AND k <> 60 THEN 0 END AS error
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)""",
    "ingest_audit": """
        WITH c AS (
            SELECT count(*) AS n, count(*) FILTER (k = 4) AS stay, count(*) FILTER (k = 9) AS at_bad,
                count(*) FILTER (k = 13) AS value_bad, count(*) FILTER (k = 60) AS error_bad,
                min(date_trunc('second', ts)) FILTER (k <> 9) AS a, max(date_trunc('second', ts)) FILTER (k <> 9) AS b
            FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)),
        o AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 50 = 0) AS bad, min(o_orderdate) AS a, max(o_orderdate) AS b
              FROM orders)
        SELECT 'CHARTEVENTS' AS table_name, 'ingested' AS status, x.name AS column_name, n AS n_rows, 3 AS n_files,
            x.bad AS bad_values, a AS first_time, b AS last_time
        FROM c, LATERAL (VALUES ('SUBJECT_ID', 0), ('ICUSTAY_ID', stay), ('CHARTTIME', at_bad), ('VALUENUM', value_bad), ('ERROR', error_bad)) AS x(name, bad)
        UNION ALL SELECT 'ADMISSIONS', 'ingested', x.name, n, 1, x.bad, a, b
        FROM o, LATERAL (VALUES ('HADM_ID', bad), ('ADMITTIME', 0)) AS x(name, bad)
        UNION ALL SELECT t, 'missing', NULL, NULL, NULL, NULL, NULL, NULL
        FROM (VALUES ('PATIENTS'), ('ICUSTAYS'), ('LABEVENTS'), ('NOTEEVENTS')) AS m(t)""",
    "csv_notes_bronze": _q(
        "px_notes",
        """SELECT note_id, hadm_id::INTEGER AS hadm_id, category, charttime, iserror, md5(text) AS text_md5
        FROM px_notes""",
    ),
    "source_audit_tables": " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file_name, true AS required, true AS present, count(*) AS n_rows FROM {t}"
        for t in _TABLES
    )
    + " UNION ALL SELECT 'd_items.parquet', false, false, NULL",
    "patient_stays": """
        WITH s AS (
            SELECT CASE WHEN l_linenumber <> 6 THEN o_custkey END AS subject_id,
                CASE WHEN l_linenumber = 7 THEN l_orderkey + 1000000000 ELSE l_orderkey END AS hadm_id,
                concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS icustay_id,
                l_shipdate AS intime, l_shipdate + to_hours(l_quantity::INTEGER) AS outtime,
                round(l_quantity / 24::DOUBLE, 6) AS los
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
        p AS (
            SELECT c_custkey AS subject_id, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
                TIMESTAMP '1890-01-01' + to_days((c_custkey * 7919 % 36500)::INTEGER) AS dob,
                CASE WHEN c_custkey % 5 = 0
                     THEN TIMESTAMP '1890-01-01' + to_days((c_custkey * 7919 % 36500)::INTEGER) + to_days(30000)
                     END AS dod
            FROM customer),
        a AS (
            SELECT o_orderkey AS hadm_id, o_orderdate AS admittime, o_orderdate + to_days(5) AS dischtime,
                o_orderkey % 2 AS hospital_expire_flag, o_orderpriority AS diagnosis, o_orderstatus AS insurance,
                'E' || (o_custkey % 5) AS ethnicity
            FROM orders),
        j AS (
            SELECT * FROM s LEFT JOIN p USING (subject_id) LEFT JOIN a USING (hadm_id)
            WHERE subject_id IS NOT NULL AND hadm_id IS NOT NULL),
        m AS (
            SELECT *, round((year(admittime) - year(dob)) * 12 + month(admittime) - month(dob)
                + CASE WHEN day(admittime) = day(dob)
                         OR (last_day(admittime) = admittime::DATE AND last_day(dob) = dob::DATE) THEN 0
                       ELSE (day(admittime) - day(dob)) / 31.0::DOUBLE END, 8) / 12 AS age
            FROM j)
        SELECT * EXCLUDE (age), round(CASE WHEN age > 89 THEN 90 ELSE age END, 6) AS age_at_admission FROM m""",
    "vitals_hourly": _q(
        _CHART + " vitals",
        """SELECT subject_id, hadm_id, icustay_id, hour_bucket, vital_name, round(mean_val, 6) AS mean_val,
            round(min_val, 6) AS min_val, round(max_val, 6) AS max_val, measurement_count FROM vitals""",
    ),
    "labs_flagged": _q(
        _CHART + " labs",
        """SELECT event_id, hadm_id, itemid, charttime, round(valuenum, 6) AS valuenum, flag, lab_name, is_abnormal
        FROM labs""",
    ),
    "notes_clean": _q(
        "px_notes clean_notes",
        "SELECT * EXCLUDE (text), length(text)::INTEGER AS n_chars FROM clean_notes",
    ),
    "outlier_flags": _q(
        _CHART,
        """, m AS (SELECT event_id, name, valuenum FROM px_chart JOIN codes USING (itemid)),
        f AS (SELECT name, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi
              FROM (SELECT name, quantile_cont(valuenum, 0.25) AS q1, quantile_cont(valuenum, 0.75) AS q3
                    FROM m GROUP BY name))
        SELECT event_id, name, round(valuenum, 6) AS valuenum, round(lo, 9) AS fence_low, round(hi, 9) AS fence_high,
            CAST(valuenum < lo OR valuenum > hi AS INTEGER) AS is_outlier
        FROM m JOIN f USING (name)""",
    ),
    "unit_normalised": _q(
        _CHART,
        """SELECT event_id, name, valueuom, round(valuenum, 6) AS valuenum,
            round(CASE WHEN name IN ('map', 'pao2') AND valueuom = 'kPa' THEN valuenum * 7.50062::DOUBLE
                       WHEN name = 'creatinine' AND valueuom = 'umol/L' THEN valuenum * (1::DOUBLE / 88.42::DOUBLE)
                       WHEN name = 'bilirubin' AND valueuom = 'umol/L' THEN valuenum * (1::DOUBLE / 17.104::DOUBLE)
                       ELSE valuenum END, 9) AS value_std
        FROM px_chart JOIN codes USING (itemid)""",
    ),
    "score_spine": _q("px_icu spine", "SELECT * FROM spine"),
    "worst_vital_24h": _q(
        _CHART + " px_icu vitals spine vital_worst",
        """SELECT icustay_id, score_window_end, round("map", 6) AS "map", round(gcs, 6) AS gcs, round(spo2, 6) AS spo2
        FROM spine LEFT JOIN vital_worst USING (icustay_id, score_window_end)""",
    ),
    "worst_lab_24h": _q(
        _CHART + " px_icu labs spine lab_worst",
        """SELECT icustay_id, score_window_end, round(creatinine, 6) AS creatinine, round(bilirubin, 6) AS bilirubin,
            round(platelet, 6) AS platelet, round(pao2, 6) AS pao2, round(fio2, 6) AS fio2
        FROM spine LEFT JOIN lab_worst USING (icustay_id, score_window_end)""",
    ),
    "sofa_scores": _q(_SCORES, f"SELECT {_SHOWN_SCORES} FROM scores"),
    "sofa_scores_adjusted": _adjusted(f"SELECT {_SHOWN_SCORES} FROM scores"),
    "tier_distribution": _q(
        _SCORES,
        """SELECT risk_tier, count(*) AS count, round(avg(sofa_total), 6) AS avg_sofa, max(sofa_total) AS max_sofa
        FROM scores GROUP BY risk_tier ORDER BY avg_sofa DESC, risk_tier""",
    ),
    "top_risk": _q(
        _SCORES,
        """SELECT icustay_id, score_window_end, sofa_total, risk_tier FROM scores
        ORDER BY sofa_total DESC, icustay_id, score_window_end LIMIT 10""",
    ),
    "latest_alerts": _q(_ALERTS, "SELECT * FROM alerts"),
    "risk_list": _q(
        _ALERTS,
        """SELECT * FROM alerts WHERE risk_tier IN ('moderate', 'high', 'critical')
        ORDER BY sofa_total DESC, icustay_id LIMIT 10""",
    ),
    "baseline_delta": _q(
        _SCORES,
        """SELECT icustay_id, score_window_end, sofa_total, baseline, sofa_total - baseline AS rise,
            coalesce(CAST(sofa_total - baseline >= 2 AS INTEGER), 0) AS rise_alert
        FROM (SELECT *, min(sofa_total) OVER (PARTITION BY icustay_id ORDER BY score_window_end
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS baseline FROM scores)""",
    ),
    "patient_timeline": _q(
        _SCORES,
        """SELECT icustay_id, string_agg(sofa_total || ':' || risk_tier || ':' || coalesce(change::VARCHAR, '-'), ' '
                ORDER BY score_window_end) AS timeline,
            count(*) AS windows, min(sofa_total) AS lowest_total, max(sofa_total) AS peak_total
        FROM (SELECT *, sofa_total - lag(sofa_total) OVER (PARTITION BY icustay_id ORDER BY score_window_end) AS change
              FROM scores) GROUP BY icustay_id""",
    ),
    "timeline_by_week": _q(
        _SCORES,
        """SELECT icustay_id, date_trunc('week', score_window_end)::TIMESTAMP AS week_start,
            string_agg(sofa_total || ':' || risk_tier || ':' || coalesce(change::VARCHAR, '-'), ' '
                ORDER BY score_window_end) AS timeline,
            count(*) AS windows, min(sofa_total) AS lowest_total, max(sofa_total) AS peak_total
        FROM (SELECT *, sofa_total - lag(sofa_total) OVER (PARTITION BY icustay_id ORDER BY score_window_end) AS change
              FROM scores) GROUP BY ALL""",
    ),
    "drain_alerts": _q(_ALERTS, "SELECT * FROM alerts"),
    "alerts_upsert": _q(
        _ALERTS,
        """, old AS (
            SELECT icustay_id, score_window_end, sofa_total, risk_tier, sofa_resp, sofa_coag, sofa_liver,
                sofa_cardio, sofa_cns, sofa_renal, score_window_end AS created_at
            FROM (SELECT * FROM scores WHERE sepsis_alert = 1
                  QUALIFY row_number() OVER (PARTITION BY icustay_id ORDER BY score_window_end) = 1)
            WHERE risk_tier <> 'critical'),
        new AS (SELECT * FROM alerts WHERE risk_tier <> 'moderate')
        SELECT new.*, coalesce(old.created_at, new.score_window_end) AS created_at FROM new LEFT JOIN old USING (icustay_id)
        UNION ALL
        SELECT * FROM old WHERE icustay_id NOT IN (SELECT icustay_id FROM new)""",
    ),
    "chunks_upsert": _with_chunks(
        "px_notes",
        [("px_notes", "old"), ("edited", "new")],
        """SELECT note_id, chunk_index, coalesce(o.subject_id, n.subject_id) AS subject_id,
            coalesce(n.category, o.category) AS category, coalesce(n.n_chars, o.n_chars)::INTEGER AS n_chars
        FROM (SELECT old.*, subject_id, category, length(chunk_text) AS n_chars FROM old JOIN px_notes USING (note_id)) o
        FULL JOIN (SELECT *, 'moved' AS subject_id, 'addendum' AS category, length(chunk_text) AS n_chars FROM new) n
            USING (note_id, chunk_index)""",
        """edited AS (SELECT note_id, repeat('Addendum. ', 300) || text AS text FROM px_notes WHERE category = 'de')""",
    ),
    "chunks_replaced": _with_chunks(
        "px_notes",
        [("px_notes", "old"), ("edited", "new")],
        """SELECT note_id, chunk_index, subject_id, category, length(chunk_text)::INTEGER AS n_chars
        FROM (SELECT * FROM old WHERE note_id NOT IN (SELECT note_id FROM edited) UNION ALL SELECT * FROM new)
        JOIN px_notes USING (note_id)""",
        """edited AS (SELECT note_id, substring(text, 1, length(text) // 2) AS text FROM px_notes WHERE category = 'fr')""",
    ),
    "metrics_insert_new": _q(
        "px_metrics",
        """SELECT query_id, provider,
            round(CASE WHEN provider <> 'error' THEN latency_ms + 1 ELSE latency_ms END, 6) AS latency_ms
        FROM px_metrics""",
    ),
    "queue_mark_done": _q(
        "px_notes px_queue",
        """SELECT queue_id, hadm_id, charttime,
            CASE WHEN embedded_at IS NULL AND length(note_text) > 1000 THEN TIMESTAMP '2024-02-01'
                 ELSE embedded_at END AS embedded_at
        FROM px_queue""",
    ),
    "pending_batch": _q(
        "px_notes px_queue",
        """SELECT queue_id, hadm_id, charttime, embedded_at FROM px_queue WHERE embedded_at IS NULL
        ORDER BY charttime DESC NULLS FIRST, queue_id LIMIT 50""",
    ),
    "pending_count": _q("px_notes px_queue", "SELECT count(*) AS pending FROM px_queue WHERE embedded_at IS NULL"),
    "not_embedded": _q("px_notes px_done fresh_notes", "SELECT note_id, content_hash FROM fresh_notes"),
    "high_risk_view": _q(
        _ALERTS,
        """SELECT *, (SELECT count(*) FROM embeddings WHERE label = alerts.icustay_id) AS embedded_note_chunks
        FROM alerts WHERE risk_tier IN ('high', 'critical') ORDER BY sofa_total DESC, icustay_id""",
    ),
    "note_sections": _with_chunks(
        "px_notes",
        [("px_notes", "c")],
        """SELECT note_id, (row_number() OVER (PARTITION BY note_id ORDER BY i) - 1)::INTEGER AS section_index,
            x AS section_text FROM c_sections WHERE x <> ''""",
    ),
    "note_windows": r"""
        WITH t AS (SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS x FROM documents),
        w AS (SELECT doc_id, i, substring(x, i * 1280 + 1, 1600) AS raw
              FROM (SELECT *, unnest(generate_series(0,
                        greatest(CAST(ceil((length(x) - 1600) / 1280.0) AS BIGINT), 0))) AS i FROM t WHERE x <> '')),
        s AS (SELECT doc_id, i, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS z,
                  i * 1280 + length(raw) - length(regexp_replace(raw, '^\s+', '')) AS start FROM w)
        SELECT doc_id AS note_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INTEGER AS chunk_index,
            start::INTEGER AS char_start, z AS chunk_text
        FROM s WHERE z <> ''""",
    "note_chunks": _with_chunks(
        "px_notes",
        [("px_notes", "c")],
        "SELECT c.*, category FROM c JOIN px_notes USING (note_id)",
    ),
    "chunk_metadata": _with_chunks(
        "px_notes",
        [("px_notes", "c")],
        """SELECT note_id, category AS note_category, chunk_index,
            '{"ISERROR":' || coalesce(iserror::VARCHAR, 'null') || ',"char_start":' || char_start || '}' AS metadata
        FROM c JOIN px_notes USING (note_id)""",
    ),
    "embed_questions": "WITH turns AS (SELECT * FROM conversations WHERE role = 'user'),"
    + _vectors("turns", "conv_id, turn", "text")
    + " SELECT conv_id, turn, 256 AS dims, coalesce(terms, 0) AS terms, length, vector_md5 FROM shown",
    "table_checks": _q(
        _ALERTS + " px_notes",
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{rule}' AS rule, count(*) AS rows, count(*) FILTER (NOT coalesce({ok}, false)) AS broken"
            f" FROM {source}"
            for t, source, rule, ok in [
                ("alerts", "alerts", "icustay_id is set", "icustay_id IS NOT NULL"),
                ("alerts", "alerts", "sofa_total in range", "sofa_total BETWEEN 0 AND 24"),
                ("alerts", "alerts", "risk_tier is known", "risk_tier IN ('low', 'moderate', 'high', 'critical')"),
                *[
                    ("alerts", "alerts", f"sofa_{o} in range", f"sofa_{o} BETWEEN 0 AND 4")
                    for o in ("resp", "coag", "liver", "cardio", "cns", "renal")
                ],
                ("chunks", "embeddings", "note_id is set", "vec_id IS NOT NULL"),
                ("chunks", "embeddings", "chunk_index is set", "true"),
                ("chunks", "embeddings", "chunk_text is set", "true"),
                ("chunks", "embeddings", "embedding has the right length", "len(embedding) = 64"),
                ("questions", "(SELECT DISTINCT label FROM embeddings)", "question is short enough", "true"),
                ("questions", "(SELECT DISTINCT label FROM embeddings)", "top_k in range", "label % 5 = 0 OR label % 7 = 3 OR label + 3 BETWEEN 1 AND 50"),
                ("questions", "(SELECT DISTINCT label FROM embeddings)", "tiers are known", "true"),
                ("notes", "px_notes", "store time is set", "storetime IS NOT NULL"),
                ("notes", "px_notes", "text is long enough", "length(text) > 50"),
            ]
        ),
    ),
    "duplicate_notes": _q(
        "px_notes",
        """SELECT subject_id, hadm_id, category, charttime, count(*) AS copies FROM px_notes GROUP BY ALL
        HAVING count(*) > 1""",
    ),
    "note_tokens": r"""
        SELECT doc_id AS note_id, ceil(length(text) / 4.0)::INTEGER AS tokens,
            len(regexp_split_to_array(text, '\s+'))::INTEGER AS words,
            length(regexp_replace(text, '^\s+|\s+$', '', 'g'))::INTEGER AS stripped_chars
        FROM documents""",
    "note_stay_join": _q(
        "px_icu px_notes",
        """SELECT note_id, n.hadm_id, s.icustay_id FROM px_notes n LEFT JOIN px_icu s
            ON s.icustay_id % 20 = n.hadm_id AND n.charttime BETWEEN s.intime AND s.outtime
        QUALIFY row_number() OVER (PARTITION BY note_id ORDER BY s.intime, s.icustay_id) = 1""",
    ),
    "embed_hashed": _with_chunks("px_notes", [("px_notes", "c")], "," + _vectors("c", "note_id, chunk_index", "chunk_text") + _SHOWN_VECTORS),
    "embed_model": _with_chunks("px_notes", [("px_notes", "c")], "," + _vectors("c", "note_id, chunk_index", "chunk_text") + _SHOWN_VECTORS),
    "embed_incremental": _with_chunks(
        "px_notes px_done fresh_notes",
        [("fresh_notes", "c")],
        "," + _vectors("c", "note_id, chunk_index", "chunk_text") + _CHUNK_VECTORS,
    ),
    "retrieve_notes": _with_chunks(
        "px_notes",
        [("px_notes", "c")],
        "," + _vectors("c", "note_id, chunk_index", "chunk_text").replace(" shown AS", " chunk_shown AS")
        .replace(" vec AS", " chunk_vec AS").replace("FROM vec)", "FROM chunk_vec)").replace(" lengths", " chunk_lengths")
        .replace(" counts", " chunk_counts").replace(" words", " chunk_words")
        + ", turns AS (SELECT conv_id || '-' || turn AS question_id, text FROM conversations WHERE role = 'user'),"
        + _vectors("turns", "question_id", "text")
        + """
        SELECT question_id, note_id, chunk_index, round(s, 6) AS cosine_similarity,
            row_number() OVER (PARTITION BY question_id ORDER BY round(s, 9) DESC, note_id, chunk_index)::INTEGER AS rank
        FROM (SELECT q.question_id, c.note_id, c.chunk_index, list_dot_product(c.v, q.v) / sqrt(list_dot_product(c.v, c.v))
                  / sqrt(list_dot_product(q.v, q.v)) AS s FROM vec q, chunk_vec c WHERE list_dot_product(q.v, q.v) > 0)
        QUALIFY rank <= 5""",
    ),
    "queue_run": _with_chunks(
        "px_notes px_queue",
        [("waiting", "c")],
        "," + _vectors("c", "note_id, chunk_index", "chunk_text")
        + """, made AS (
            SELECT note_id, count(*) AS n, md5(string_agg(vector_md5, ',' ORDER BY chunk_index)) AS m FROM shown GROUP BY 1)
        SELECT queue_id, coalesce(embedded_at, TIMESTAMP '2024-02-01') AS embedded_at,
            CASE WHEN embedded_at IS NOT NULL THEN 1 ELSE coalesce(n, 0) END AS n_chunks,
            CASE WHEN embedded_at IS NOT NULL THEN md5(md5('[0.50000000]')) ELSE m END AS vectors_md5
        FROM px_queue LEFT JOIN made ON note_id = queue_id""",
        """waiting AS (SELECT queue_id AS note_id, CASE WHEN queue_id % 29 = 0 THEN '  ' ELSE note_text END AS text
            FROM px_queue WHERE embedded_at IS NULL)""",
    ),
    "notes_backfill": _with_chunks(
        "px_notes",
        [("px_notes", "c")],
        "," + _vectors("c", "note_id, chunk_index", "chunk_text")
        + " SELECT note_id, chunk_index, char_start, vector_md5 FROM shown JOIN c USING (note_id, chunk_index)",
    ),
    "vectors_as_text": """
        SELECT vec_id, '[' || array_to_string(list_transform(embedding, lambda x: format('{:.8f}', x::DOUBLE)), ',') || ']'
            AS vector_text FROM embeddings""",
    "vectors_normalised": _q(
        "cells",
        """SELECT vec_id, (pos - 1)::INTEGER AS pos,
            round(x * 3 / sqrt(sum(x * 3 * x * 3) OVER (PARTITION BY vec_id)), 6) AS x FROM cells""",
    ),
    "cosine_topk": _q(
        "px_vectors cells",
        """, q AS (SELECT list(m ORDER BY pos) AS v FROM (SELECT pos, avg(x) AS m FROM cells GROUP BY pos))
        SELECT note_id, icustay_id, round(list_cosine_similarity(c.v, q.v), 6) AS cosine_similarity
        FROM px_vectors c, q ORDER BY round(list_cosine_similarity(c.v, q.v), 9) DESC, note_id LIMIT 10""",
    ),
    "cosine_topk_by_stay": _q(
        _ALERTS + " px_vectors cells",
        """, q AS (SELECT list(m ORDER BY pos) AS v FROM (SELECT pos, avg(x) AS m FROM cells GROUP BY pos))
        SELECT note_id, icustay_id, round(list_cosine_similarity(c.v, q.v), 6) AS cosine_similarity
        FROM px_vectors c, q
        WHERE icustay_id IN (SELECT icustay_id FROM alerts ORDER BY sofa_total DESC, icustay_id LIMIT 5)
        ORDER BY round(list_cosine_similarity(c.v, q.v), 9) DESC, note_id LIMIT 10""",
    ),
    "cosine_topk_batch": _q(
        "px_vectors cells questions",
        """SELECT question_id, note_id, round(s, 6) AS cosine_similarity,
            row_number() OVER (PARTITION BY question_id ORDER BY round(s, 9) DESC, note_id)::INTEGER AS rank
        FROM (SELECT question_id, note_id, list_cosine_similarity(c.v, q.v) AS s FROM px_vectors c, questions q)
        QUALIFY rank <= 10""",
    ),
    "ann_cells": _ann_cells(),
    "question_risk_lists": _q(
        _RISK, "SELECT question_id, patient_rank, icustay_id, sofa_total, risk_tier FROM risk"
    ),
    "supporting_notes": _q(_FOUND + " support", "SELECT * FROM support"),
    "prompt_patients": _q(_RISK + " patient_text", "SELECT * FROM patient_text"),
    "prompt_excerpts": _q(_FOUND + " excerpt_text", "SELECT * FROM excerpt_text"),
    "prompt_full": _q(_FOUND + " patient_text excerpt_text", _PROMPTS),
    "prompt_messages": _q(
        _FOUND + " patient_text excerpt_text",
        f""", prompts AS ({_PROMPTS})
        SELECT question_id, 0 AS place, 'system' AS role, '{_SYSTEM}' AS content FROM prompts
        UNION ALL SELECT question_id, 1, 'user', prompt FROM prompts""",
    ),
    "answer_metrics": _q(
        _RISK + " px_metrics",
        """SELECT question_id::VARCHAR AS query_id, question AS query_text, provider, model, round(latency_ms, 6) AS latency_ms,
            tokens_used, round(estimated_cost_usd, 6) AS estimated_cost_usd, n AS patients_returned,
            (SELECT max(ts) FROM events) AS queried_at
        FROM (SELECT question_id, count(*) AS n FROM risk GROUP BY 1) JOIN questions USING (question_id)
            JOIN px_metrics ON query_id = question_id""",
    ),
    "answer_records": _q(
        _FOUND + " support",
        """SELECT question_id, patient_rank, icustay_id, sofa_total, sofa_resp AS respiratory, sofa_cns AS cns,
            score_window_end, 'Reviewed ' || question_id AS summary, coalesce(n, 0)::INTEGER AS n_notes,
            coalesce(joined, '') AS supporting_notes
        FROM risk LEFT JOIN (SELECT question_id, icustay_id, count(*) AS n,
                                 string_agg(note, '|' ORDER BY note_rank) AS joined
                             FROM support GROUP BY ALL) USING (question_id, icustay_id)""",
    ),
    "answers": _q(
        _RISK + " px_metrics",
        """SELECT question_id, question, provider, CASE WHEN n > 0 THEN model ELSE 'n/a' END AS model,
            coalesce(n, 0) AS patients_at_risk, coalesce(ids, '') AS alerts,
            CASE WHEN n > 0 THEN round(latency_ms, 2) ELSE 0 END AS latency_ms,
            CASE WHEN n > 0 THEN tokens_used END AS tokens_used,
            CASE WHEN n > 0 THEN round(estimated_cost_usd, 6) END AS estimated_cost_usd
        FROM questions
        LEFT JOIN (SELECT question_id, count(*) AS n, string_agg(icustay_id::VARCHAR, ',' ORDER BY patient_rank) AS ids
                   FROM risk GROUP BY question_id) USING (question_id)
        LEFT JOIN px_metrics ON query_id = question_id""",
    ),
    "usage_24h": _q("px_metrics recent", _usage("recent")),
    "usage_all_time": _q("px_metrics", _usage("px_metrics")),
    "cost_24h": _q(
        "px_metrics recent",
        """SELECT provider, count(*) AS query_count, round(avg(latency_ms), 6) AS avg_latency_ms,
            sum(tokens_used)::BIGINT AS total_tokens, round(sum(estimated_cost_usd), 8) AS total_cost_usd
        FROM recent GROUP BY provider""",
    ),
    "tier_counts": _q(
        _ALERTS,
        "SELECT risk_tier, count(*) AS patient_count FROM alerts GROUP BY risk_tier ORDER BY patient_count DESC, risk_tier",
    ),
    "metrics_summary": _q(
        _ALERTS + " px_metrics recent px_notes px_queue",
        """SELECT (SELECT string_agg(provider || ':' || n || ':' || t, ';' ORDER BY provider)
             FROM (SELECT provider, count(*) AS n, sum(tokens_used)::BIGINT AS t FROM recent GROUP BY provider)) AS usage,
            (SELECT string_agg(risk_tier || ':' || n, ';' ORDER BY n DESC, risk_tier DESC)
             FROM (SELECT risk_tier, count(*) AS n FROM alerts GROUP BY risk_tier)) AS tiers,
            (SELECT count(*) FROM px_queue WHERE embedded_at IS NULL) AS embedding_queue_pending""",
    ),
    "request_cost": _q(
        "px_metrics",
        """SELECT query_id, model, tokens_in, tokens_out, round(estimated_cost_usd, 6) AS cost_usd,
            round(latency_ms, 2) AS latency_ms FROM px_metrics""",
    ),
    "latency_histogram": _q(
        "px_metrics",
        " UNION ALL ".join(
            f"SELECT provider, '{b}' AS le, count(*) FILTER (latency_ms / 1000::DOUBLE <= {b}) AS cumulative_count"
            " FROM px_metrics GROUP BY provider"
            for b in _BOUNDS
        )
        + " UNION ALL SELECT provider, '+Inf', count(*) FROM px_metrics GROUP BY provider",
    ),
    "latency_quantiles": _q(
        "px_metrics",
        f"""SELECT window_start, provider, {_quantile(0.5)} AS p50, {_quantile(0.95)} AS p95, {_quantile(0.99)} AS p99
        FROM (SELECT time_bucket(INTERVAL '5 minutes', queried_at) AS window_start, provider, {_le_columns()}
              FROM px_metrics GROUP BY ALL)""",
    ),
    "query_counter": _q(
        "px_metrics",
        """SELECT provider, 'all' AS risk_tier, count(*) AS queries_total, sum(tokens_used)::BIGINT AS tokens_total,
            round(sum(estimated_cost_usd), 8) AS cost_usd_total FROM px_metrics GROUP BY provider""",
    ),
    "token_counter": _q(
        "px_metrics",
        """SELECT provider, 'input' AS token_type, sum(tokens_in)::BIGINT AS tokens_total FROM px_metrics GROUP BY provider
        UNION ALL SELECT provider, 'output', sum(tokens_out)::BIGINT FROM px_metrics GROUP BY provider""",
    ),
    "query_rate": _q(
        "px_metrics",
        """SELECT time_bucket(INTERVAL '1 minute', queried_at) AS window_start, provider, count(*) AS queries,
            round(count(*) / 60::DOUBLE, 6) AS per_second FROM px_metrics GROUP BY ALL""",
    ),
    "token_rate": _q(
        "px_metrics",
        """SELECT window_start, provider, token_type, tokens, round(tokens / 300::DOUBLE, 6) AS per_second FROM (
            SELECT time_bucket(INTERVAL '5 minutes', queried_at) AS window_start, provider, 'input' AS token_type,
                sum(tokens_in)::BIGINT AS tokens FROM px_metrics GROUP BY ALL
            UNION ALL
            SELECT time_bucket(INTERVAL '5 minutes', queried_at), provider, 'output', sum(tokens_out)::BIGINT
            FROM px_metrics GROUP BY ALL)""",
    ),
    "cost_rate": _q(
        "px_metrics",
        """SELECT window_start, provider, round(c, 8) AS cost_usd, round(c / 3600::DOUBLE, 12) AS usd_per_second,
            round(c, 8) AS usd_per_hour
        FROM (SELECT time_bucket(INTERVAL '1 hour', queried_at) AS window_start, provider, sum(estimated_cost_usd) AS c
              FROM px_metrics GROUP BY ALL)""",
    ),
    "panel_status": _q(
        _ALERTS + " px_metrics recent",
        f"""SELECT panel, label, round(value, 8) AS value, status FROM (
            SELECT 'p95_latency_seconds' AS panel, provider AS label, v AS value, {_status('v', 5, 15)} AS status
            FROM (SELECT provider, {_quantile(0.95, 12)} AS v
                  FROM (SELECT provider, {_le_columns()} FROM px_metrics GROUP BY provider))
            UNION ALL
            SELECT 'cost_usd_24h', provider, c, {_status('c', 1, 5)}
            FROM (SELECT provider, sum(estimated_cost_usd) AS c FROM recent GROUP BY provider)
            UNION ALL
            SELECT 'active_alerts', risk_tier, n::DOUBLE, {_status('n', 5, 15)}
            FROM (SELECT risk_tier, count(*) AS n FROM alerts GROUP BY risk_tier))""",
    ),
    "stream_vitals_hourly": _q(
        _CHART,
        f""", h AS ({_VITAL_STREAM})
        SELECT icustay_id, vital_name, hour_bucket, round(mean_val, 6) AS mean_val, round(min_val, 6) AS min_val,
            round(max_val, 6) AS max_val, measurement_count FROM h""",
    ),
    "stream_worst_24h": _q(
        _CHART,
        f""", h AS ({_VITAL_STREAM})
        SELECT icustay_id, vital_name, hour_bucket + to_hours(i) AS window_end, round(min(mean_val), 6) AS worst
        FROM (SELECT *, unnest(generate_series(1, 24)) AS i FROM h) GROUP BY ALL""",
    ),
    "stream_metrics": _q(
        "px_metrics",
        "SELECT time_bucket(INTERVAL '5 minutes', queried_at) AS window_start, provider, count(*) AS queries, "
        "sum(tokens_used)::BIGINT AS tokens, round(sum(estimated_cost_usd), 8) AS cost_usd, "
        + ", ".join(f"count(*) FILTER (latency_ms <= {b * 1000}) AS le_{i}" for i, b in enumerate(_BOUNDS))
        + " FROM px_metrics GROUP BY ALL",
    ),
    "stream_note_dedup": _q(
        "px_notes clean_notes", "SELECT note_id, category, charttime, storetime, word_count FROM clean_notes"
    ),
    "stream_embed": _with_chunks(
        "px_notes", [("px_notes", "c")], "," + _vectors("c", "note_id, chunk_index", "chunk_text") + _CHUNK_VECTORS
    ),
}
