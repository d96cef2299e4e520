"""The same results as plain SQL for DuckDB, written out independently of the
library: rule values, formulas and draws are all stated here again."""

from __future__ import annotations

from workload.tables import ANNOTATIONS_SQL, SCORED_PROPERTIES

# Fixed values. property: (weight, default, labels with scores best first)
RULES = {
    "content_quality": (3.0, 0.5, {"excellent": 1.0, "good": 0.75, "adequate": 0.4, "poor": 0.1, "unacceptable": 0.0}),
    "content_safety": (5.0, 0.5, {"safe": 1.0, "mild_concerns": 0.5, "nsfw": 0.0, "harmful": 0.0, "illegal": 0.0}),
    "educational_value": (2.0, 0.5, {"high": 1.0, "moderate": 0.7, "basic": 0.4, "minimal": 0.15, "none": 0.0}),
    "reasoning_indicators": (1.5, 0.5, {"analytical": 1.0, "explanatory": 0.7, "basic_reasoning": 0.4, "minimal": 0.15, "none": 0.0}),
    "content_integrity": (2.0, 0.5, {"complete": 1.0, "mostly_complete": 0.7, "fragment": 0.2, "severely_degraded": 0.0}),
    "information_density": (1.0, 0.5, {"dense": 1.0, "adequate": 0.7, "moderate": 0.4, "thin": 0.15, "empty": 0.0}),
    "commercial_bias": (1.5, 0.5, {"none": 1.0, "minimal": 0.8, "moderate": 0.4, "heavy": 0.1, "pure_marketing": 0.0}),
}
SOME = {
    "content_quality": (3.0, 0.5, {"excellent": 1.0, "good": 0.75, "adequate": 0.4, "poor": 0.1}),
    "educational_value": (2.0, 0.5, {"high": 1.0, "moderate": 0.7, "basic": 0.4, "minimal": 0.15}),
    "commercial_bias": (1.5, 0.25, {"none": 1.0, "minimal": 0.8, "moderate": 0.4, "heavy": 0.1}),
}


def _number(value) -> str:
    return f"{float(value)}e0"


def _case(prop: str, rule) -> str:
    _, default, scores = rule
    arms = " ".join(f"WHEN '{label}' THEN {_number(score)}" for label, score in scores.items())
    return f"CASE {prop} {arms} ELSE {_number(default)} END"


def _weighted_sum(rules) -> str:
    return " + ".join(f"{_case(prop, rule)} * {_number(rule[0])}" for prop, rule in rules.items())


def _weight(rules) -> str:
    return _number(sum(rule[0] for rule in rules.values()))


ANN = "ann AS (" + ANNOTATIONS_SQL.format(labels="labels", documents="documents") + ")"
SCORES = f"""{ANN},
raw AS (SELECT id, ({_weighted_sum(RULES)}) / {_weight(RULES)} AS raw FROM ann),
bounds AS (SELECT min(raw) AS lo, max(raw) AS hi FROM raw),
scores AS (SELECT id, CASE WHEN hi > lo THEN (raw - lo) / (hi - lo) ELSE raw END AS score FROM raw, bounds)"""
SCORED = f"""{SCORES},
scored AS (SELECT d.doc_id AS source_pos, coalesce(s.score, 0.0e0) AS score, s.id IS NOT NULL AS matched
  FROM documents d LEFT JOIN scores s ON s.id = d.doc_id),
total AS (SELECT count(*) AS n FROM scored)"""


def _u(*keys: str) -> str:
    text = "concat_ws(':', '42', " + ", ".join(keys) + ")"
    return f"((('0x' || substr(md5({text}), 1, 13))::bigint)::double + 0.5e0) / 4503599627370496e0"


def _race(n: str, cap: int, order: str) -> str:
    """First n arrivals; ``order`` ranks them."""
    return f"""{SCORED},
arrivals AS (
  SELECT source_pos, score, k, sum(-ln({_u("source_pos::varchar", "k::varchar")}))
    OVER (PARTITION BY source_pos ORDER BY k) / score AS t
  FROM scored, range(1, {cap + 1}) AS copies(k) WHERE score > 0),
firsts AS (
  SELECT *, row_number() OVER (ORDER BY t, source_pos, k) - 1 AS arrival FROM arrivals),
drawn AS (
  SELECT source_pos, score, row_number() OVER (ORDER BY {order}) - 1 AS draw_pos
  FROM firsts WHERE arrival < (SELECT {n} FROM total))"""


SHUFFLE = _u("'order'", "source_pos::varchar", "k::varchar") + ", t, source_pos, k"
WOR = _race("n // 5", 1, "t, source_pos")
CAPPED = _race("n // 2", 3, SHUFFLE)
REPLACED = f"""{SCORED},
sums AS (SELECT sum(score) AS w, max(score) AS top FROM scored WHERE score > 0),
sized AS (SELECT source_pos, score,
    greatest(1, floor(score / top * pow(2, floor(61 - round(log2(w / top), 6)))))::bigint AS length
  FROM scored, sums WHERE score > 0),
line AS (SELECT source_pos, score, (sum(length) OVER (ORDER BY source_pos))::bigint AS finish, length FROM sized),
spans AS (SELECT source_pos, score, finish - length AS start FROM line),
points AS (SELECT i AS draw_pos,
    least(floor({_u("'draw'", "i::varchar")} * (SELECT max(finish) FROM line)::double), (SELECT max(finish) FROM line) - 1)::bigint AS x
  FROM (SELECT unnest(range(2 * n)) AS i FROM total)),
drawn AS (SELECT p.draw_pos, s.source_pos, s.score FROM points p ASOF JOIN spans s ON p.x >= s.start)"""

DRAWN = "SELECT source_pos, draw_pos, round(score, 9) AS score FROM drawn"
PAYLOAD = """SELECT {pos}, doc_id, lang, source, n_chars, md5(text) AS text_md5, round(score, 9) AS score
FROM {rows} JOIN documents ON doc_id = source_pos"""


def _distribution(rows: str) -> str:
    cuts = ", ".join(
        f"round(quantile_cont(score, {p / 100}), 9) AS p{p}" for p in (10, 25, 50, 75, 90)
    )
    return f"""round(avg(score), 9) AS mean, round(quantile_cont(score, 0.5), 9) AS median,
round(stddev_pop(score), 9) AS std, round(min(score), 9) AS min, round(max(score), 9) AS max, {cuts} FROM {rows}"""


def _some_scores(expression: str) -> str:
    return f"WITH {ANN} SELECT id, round({expression}, 9) AS score FROM ann"


_SOME_CASES = [_case(prop, rule) for prop, rule in SOME.items()]
_USE = " UNION ALL ".join(
    f"SELECT '{prop}' AS property, {prop} AS label, count(*) AS rows FROM ann GROUP BY {prop}"
    for prop in SCORED_PROPERTIES
)
_RULE_ROWS = ", ".join(
    f"('{prop}', '{label}', {_number(score)}, {_number(weight)}, {_number(default)})"
    for prop, (weight, default, scores) in RULES.items() for label, score in scores.items()
)
_LABELS = ", ".join(
    f"('{prop}', '{label}', {rank}, {_number(size - rank + 1)}, {_number((size - rank) / (size - 1))})"
    for prop, (_, _, scores) in RULES.items()
    for size in [len(scores)] for rank, label in enumerate(scores, 1)
)


def _ordinal(prop: str, top: bool) -> str:
    labels = RULES[prop][2]
    size = len(labels)
    arms = " ".join(
        f"WHEN '{label}' THEN {_number((size - 1 - i) / (size - 1) if top else size - i)}"
        for i, label in enumerate(labels)
    )
    return f"round(CASE {prop} {arms} END, 9) AS {prop}_norm" if top else f"CASE {prop} {arms} END AS {prop}"


ORACLE: dict[str, str] = {
    "scan_annotations": """SELECT doc_id AS id, quality, toxic,
        row_number() OVER (ORDER BY doc_id) - 1 AS annotation_pos FROM labels""",
    "source_positions": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS source_pos FROM documents",
    "scoring_rules": f"""WITH {ANN}, used AS ({_USE}),
        rules(property, label, score, weight, default_score) AS (VALUES {_RULE_ROWS})
        SELECT r.*, coalesce(u.rows, 0)::bigint AS rows FROM rules r LEFT JOIN used u USING (property, label)""",
    "label_dimension": f"""WITH {ANN}, used AS ({_USE}),
        labels_(property, label, rank, score, norm_score) AS (VALUES {_LABELS})
        SELECT property, label, rows::bigint AS rows, rank::integer AS rank, score, round(norm_score, 9) AS norm_score
        FROM used LEFT JOIN labels_ USING (property, label)""",
    "category_scores": f"WITH {ANN} SELECT id, "
        + ", ".join(f"{_case(prop, rule)} AS {prop}" for prop, rule in RULES.items()) + " FROM ann",
    "score_skips_absent": _some_scores(_case("content_quality", SOME["content_quality"])),
    "score_weighted_mean": _some_scores(f"({_weighted_sum(SOME)}) / {_weight(SOME)}"),
    "score_weighted_sum": _some_scores(_weighted_sum(SOME)),
    "score_min": _some_scores(f"least({', '.join(_SOME_CASES)})"),
    "score_product": _some_scores(" * ".join(_SOME_CASES)),
    "score_normalized": f"WITH {SCORES} SELECT id, round(score, 9) AS score FROM scores",
    "ordinal_encode": f"WITH {ANN} SELECT id, "
        + ", ".join(_ordinal(prop, top) for top in (False, True) for prop in RULES) + " FROM ann",
    "select_threshold": f"WITH {SCORED} SELECT source_pos, round(score, 9) AS score FROM scored WHERE score >= 0.7e0",
    "score_join": f"WITH {SCORED} SELECT source_pos AS id, round(score, 9) AS score, matched FROM scored",
    "dedup_annotations": """WITH raw AS (
          SELECT conv_id AS id, turn, CASE role WHEN 'assistant' THEN 0.9e0 WHEN 'user' THEN 0.3e0 ELSE 0.1e0 END AS raw
          FROM conversations),
        bounds AS (SELECT min(raw) AS lo, max(raw) AS hi FROM raw)
        SELECT id, round(arg_max(CASE WHEN hi > lo THEN (raw - lo) / (hi - lo) ELSE raw END, turn), 9) AS score
        FROM raw, bounds GROUP BY id""",
    "gather_rows": f"WITH {REPLACED} " + PAYLOAD.format(pos="draw_pos", rows="drawn"),
    "score_distribution": f"WITH {SCORED} SELECT " + _distribution("scored"),
    "match_rate": f"""WITH {SCORED} SELECT count(*) AS rows, count(*) FILTER (matched) AS matched,
        round(count(*) FILTER (matched) / count(*)::double, 9) AS match_rate FROM scored""",
    "weight_totals": f"""WITH {SCORED} SELECT round(sum(greatest(score, 0)), 9) AS weight_sum,
        count(*) FILTER (score > 0) AS eligible FROM scored""",
    "selection_summary": f"""WITH {SCORED} SELECT count(*) AS source_rows,
        count(*) FILTER (score >= 0.7e0) AS selected_rows,
        round(count(*) FILTER (score >= 0.7e0) / count(*)::double, 9) AS ratio FROM scored""",
    "sample_wor": f"WITH {WOR} {DRAWN}",
    "sample_wor_capped_n": f"WITH {_race('n', 1, 't, source_pos')} {DRAWN}",
    "sample_wr": f"WITH {REPLACED} {DRAWN}",
    "sample_wr_capped": f"WITH {CAPPED} {DRAWN}",
    "sample_wr_capacity": f"WITH {_race('10 * n', 2, SHUFFLE)} {DRAWN}",
    "order_source": f"""WITH {CAPPED} SELECT source_pos,
        row_number() OVER (ORDER BY source_pos) - 1 AS out_pos FROM drawn""",
    "order_draw": f"""WITH {CAPPED} SELECT draw_pos AS out_pos, doc_id, n_chars
        FROM drawn JOIN documents ON doc_id = source_pos""",
    "global_position": """SELECT doc_id, n_chars,
        row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS pos FROM documents""",
    "shard_assignment": f"""WITH {CAPPED}, ordered AS (
          SELECT source_pos AS doc_id, row_number() OVER (ORDER BY source_pos) - 1 AS out_pos FROM drawn)
        SELECT (out_pos // greatest(1, (SELECT count(*) FROM drawn) // 7))::integer AS shard, out_pos, doc_id FROM ordered""",
    "provenance": f"""WITH {CAPPED}, facts AS (SELECT count(*) AS source_rows FROM documents), chosen AS (
          SELECT count(*) AS selected_rows, """ + _distribution("drawn") + """)
        SELECT 'curated' AS name, 'documents' AS source_dataset, 'labels' AS annotations, 'all_properties' AS config,
          'sample_with_replacement' AS mode, NULL::double AS threshold, (source_rows // 2)::bigint AS n_samples,
          3::bigint AS max_duplications,
          42 AS seed, 'draw' AS row_order, source_rows,
          round(100 * selected_rows / source_rows::double, 9) AS selected_percent, chosen.* FROM facts, chosen""",
    "curate_threshold": f"""WITH {SCORED}, kept AS (
          SELECT source_pos, score, row_number() OVER (ORDER BY source_pos) - 1 AS out_pos FROM scored WHERE score >= 0.7e0) """
        + PAYLOAD.format(pos="out_pos", rows="kept"),
    "curate_wor": f"WITH {WOR} " + PAYLOAD.format(pos="draw_pos AS out_pos", rows="drawn"),
    "curate_wr": f"WITH {REPLACED} " + PAYLOAD.format(pos="draw_pos AS out_pos", rows="drawn"),
    "curate_wr_capped": f"WITH {CAPPED} " + PAYLOAD.format(pos="draw_pos AS out_pos", rows="drawn"),
}
LAST_TURNS = """raw AS (
  SELECT conv_id AS id, turn, CASE role WHEN 'assistant' THEN 0.9e0 WHEN 'user' THEN 0.3e0 ELSE 0.1e0 END AS raw
  FROM conversations),
bounds AS (SELECT min(raw) AS lo, max(raw) AS hi FROM raw),
last AS (
  SELECT id, arg_max(CASE WHEN hi > lo THEN (raw - lo) / (hi - lo) ELSE raw END, turn) AS score
  FROM raw, bounds GROUP BY id)"""
# Queries that take the plans for large tables give the rows of the plain ones.
ORACLE |= {
    "curate_by_key": ORACLE["curate_threshold"],
    "curate_by_position": ORACLE["curate_threshold"],
    "curate_last_annotation": f"""WITH {LAST_TURNS}
        SELECT row_number() OVER (ORDER BY doc_id) - 1 AS out_pos, doc_id, round(score, 9) AS score
        FROM documents JOIN last ON id = doc_id WHERE score >= 0.5e0""",
    "curate_last_row": f"""WITH {LAST_TURNS}
        SELECT row_number() OVER (ORDER BY doc_id) - 1 AS out_pos, doc_id, round(score, 9) AS score
        FROM documents JOIN last ON id = doc_id WHERE score >= 0.5e0""",
    "curate_by_key_wr": ORACLE["curate_wr"],
    "order_draw_directory": f"""WITH {REPLACED}
        SELECT (draw_pos // greatest(1, (SELECT count(*) FROM drawn) // 7))::integer AS shard, draw_pos AS out_pos, doc_id, n_chars
        FROM drawn JOIN documents ON doc_id = source_pos""",
    "shard_sizes": f"""WITH {CAPPED}, ordered AS (SELECT row_number() OVER (ORDER BY source_pos) - 1 AS out_pos FROM drawn)
        SELECT (out_pos // greatest(1, (SELECT n FROM total) // 3))::integer AS shard, count(*) AS rows FROM ordered GROUP BY shard""",
    "gather_positions": """WITH asked AS (SELECT doc_id AS out_pos, doc_id * 7 % (SELECT count(*) FROM documents) AS source_pos FROM documents)
        SELECT out_pos, source_pos, doc_id, n_chars FROM asked JOIN documents ON doc_id = source_pos""",
    "score_long_rules": """SELECT doc_id AS id,
        CASE WHEN n_chars % 300 < 247 THEN round((n_chars % 300 * 7 % 11) / 10e0, 9) ELSE 0.5e0 END AS score FROM documents""",
    "score_distribution_approx": f"""WITH {SCORED}, facts AS (
          SELECT count(*) AS rows, round(avg(score), 9) AS mean, round(min(score), 9) AS min, round(max(score), 9) AS max FROM scored)
        SELECT percent, true AS within, facts.* FROM facts, (VALUES (10), (25), (50), (75), (90)) AS percents(percent)""",
    "sample_wor_bucketed": ORACLE["sample_wor"],
    "sample_wr_capped_pruned": f"WITH {_race('n // 2', 300, SHUFFLE)} {DRAWN}",
    "sample_wr_blocks": ORACLE["sample_wr"],
    "score_distribution_multipass": ORACLE["score_distribution"],
    "score_join_skewed": f"""WITH {LAST_TURNS}
        SELECT c.conv_id AS id, turn, round(score, 9) AS score, true AS matched FROM conversations c JOIN last ON id = conv_id""",
    "weight_totals_negative": f"""WITH {SCORED} SELECT round(sum(greatest(score - 0.5e0, 0)), 9) AS weight_sum,
        count(*) FILTER (score - 0.5e0 > 0) AS eligible FROM scored""",
}
