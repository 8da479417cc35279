"""The same results in plain SQL, with a loan's months as one ordered list rather than a single grouping.

Named pieces are spliced together as common table expressions; each piece lists the
pieces it reads.
"""

from __future__ import annotations

from ..schema import (
    ALL_FEATURES,
    CATEGORICAL_FEATURES,
    CORE_COLUMNS,
    FEATURE_ROW_COLUMNS,
    MARKET_FEATURES,
    NUMERIC_FEATURES,
    ORIGINATION_COLUMNS,
    WINDOW_FEATURES,
    panel_schema,
)
from ..operators.scoring import Scorecard
from . import tables
from .queries import CARDS, FULL_CARDS, SAMPLE_SIZE

_DOUBLES = {f.name for f in panel_schema().fields if f.dataType.typeName() == "double"}
_NUMBERS = {f.name for f in panel_schema().fields if f.dataType.typeName() in ("double", "integer")}
_MACRO = (
    "macro_mortgage30us", "macro_unrate", "macro_dgs10", "macro_term_spread_10y3m",
    "hpi_state_curr", "hpi_state_growth_1y", "hpi_state_orig",
)
_FLOAT_COLUMNS = {"ORIG_RATE", "ORIG_UPB", "f12_last_upb", "f12_upb_paid_ratio", *MARKET_FEATURES}


def _month(text: str) -> str:
    return f"(CAST(substr({text}, 3, 4) AS INTEGER) * 12 + CAST(substr({text}, 1, 2) AS INTEGER))"


def _quarter(text: str) -> str:
    return f"(CAST(substr({text}, 3, 4) AS INTEGER) * 10 + (CAST(substr({text}, 1, 2) AS INTEGER) + 2) // 3)"


def _split(vintage: str) -> str:
    year = f"CAST(substr({vintage}, 1, 4) AS INTEGER)"
    cases = " ".join(f"WHEN {year} BETWEEN {lo} AND {hi} THEN '{n}'" for n, (lo, hi) in tables.BANDS.items())
    return f"CASE {cases} ELSE '{tables.BANDS.rest}' END"


def _number(value: float) -> str:
    return f"({value!r}::DOUBLE)"


def _score(card: Scorecard) -> str:
    z = _number(card.intercept)
    for t in card.terms:
        z = f"({z} + {_number(t.weight)} * (coalesce(CAST({t.feature} AS DOUBLE), {_number(t.fill)}) - {_number(t.center)}))"
    return f"round(1.0::DOUBLE / (1.0::DOUBLE + exp(-({z}))), {card.digits})"


def _rounded(columns: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c in _FLOAT_COLUMNS else c for c in columns)


def _known(field: str, months: str, place: int) -> str:
    """First (1) or last (-1) known value of a field in an ordered list of months."""
    return f"[m.{field} FOR m IN {months} IF m.{field} IS NOT NULL][{place}]"


def _some(condition: str, months: str) -> str:
    return f"CAST(len([m FOR m IN {months} IF {condition}]) > 0 AS INTEGER)"


def _times(condition: str, months: str) -> str:
    return f"len([m FOR m IN {months} IF {condition}])"


_TOLD = sorted({*ORIGINATION_COLUMNS, "CURRENT_UPB", "MOD_FLAG", "DLQ_STATUS", "ZB_CODE"})

# Everything about a loan that its own months tell: output column -> expression over the lists of _PIECES["parts"].
_OWN: dict[str, str] = {
    **{c: _known(c, "story", 1) for c in ORIGINATION_COLUMNS},
    "f12_n_obs": "len(opening)",
    "f12_dlq_max": "list_max([m.late FOR m IN opening])",
    **{f"f12_months_{30 * k}p": _times(f"m.late >= {k}", "opening") for k in (1, 2, 3)},
    **{f"f12_ever_{30 * k}": _some(f"m.late >= {k}", "opening") for k in (1, 2, 3)},
    "f12_mod_flag": _some("m.MOD_FLAG = 'Y'", "opening"),
    "f12_forbearance": _some("m.DLQ_STATUS = 'XX'", "opening"),
    "f12_last_upb": _known("CURRENT_UPB", "opening", -1),
    "f12_last_age_seen": "opening[-1].age",
    "observed_through_age": "story[-1].age",
    "ever_terminal": _some("m.ZB_CODE IS NOT NULL", "story"),
    "first_terminal_age": "[m.age FOR m IN story IF m.ZB_CODE IS NOT NULL][1]",
    "y_delinq_90p": _some("m.late >= 3", "second_year"),
    "y_prepay": _some("m.ZB_CODE = '01'", "second_year"),
    "y_default_zb": _some("m.ZB_CODE IN ('02', '03', '09', '15')", "second_year"),
    "lw_forbearance": _some("m.DLQ_STATUS = 'XX'", "second_year"),
    "lw_n_obs": "len(second_year)",
}


def _wide(context: bool) -> str:
    """The whole loan row. Without market context its columns are NULL."""
    if context:
        source = "told LEFT JOIN outlook USING (vintage, LOAN_ID)"
        given = ", ".join(_MACRO)
    else:
        source = f"(SELECT *, {', '.join(f'NULL::DOUBLE AS {c}' for c in _MACRO)} FROM told)"
        given = ", ".join(_MACRO)
    return f"""
      SELECT *, nullif(greatest(OLTV, 0), 0) / nullif(greatest(hpi_state_ratio_curr_to_orig, 0), 0) AS est_current_ltv_from_oltv
      FROM (SELECT * EXCLUDE ({given}), {given},
              (ORIG_UPB - f12_last_upb) / nullif(greatest(ORIG_UPB, 0), 0) AS f12_upb_paid_ratio,
              hpi_state_curr / nullif(greatest(hpi_state_orig, 0), 0) AS hpi_state_ratio_curr_to_orig,
              ORIG_RATE - macro_mortgage30us AS rate_incentive,
              CAST(observed_through_age >= 24 OR ever_terminal = 1 AS INTEGER) AS eligible
            FROM {source})"""


_KEY = ("model", "task", "split")
_KEYS = ", ".join(_KEY)
_CARD_ROWS = " UNION ALL ".join(
    f"SELECT '{c.model}' AS model, '{c.task}' AS task, {_split('vintage')} AS split, LOAN_ID, vintage, "
    f"{'y_delinq_90p' if c.task == 'delinq' else 'y_prepay'} AS y_true, {_score(c)} AS y_score "
    "FROM plain WHERE eligible = 1"
    for c in CARDS
)

# name -> (pieces it reads, SQL)
_PIECES: dict[str, tuple[tuple[str, ...], str]] = {
    "panel": ((), tables.PANEL_SQL),
    "aged": (
        ("panel",),
        f"""SELECT * FROM (SELECT *, {_month('ACT_PERIOD')} AS mi, TRY_CAST(DLQ_STATUS AS INTEGER) AS late,
              coalesce(LOAN_AGE, {_month('ACT_PERIOD')} - {_month('ORIG_DATE')}) AS age FROM panel) WHERE age >= 0""",
    ),
    "stories": (
        ("aged",),
        "SELECT vintage, LOAN_ID, list(struct_pack(age := age, late := late, "
        + ", ".join(f"{c} := {c}" for c in _TOLD)
        + ") ORDER BY age, mi) AS story FROM aged GROUP BY vintage, LOAN_ID",
    ),
    "parts": (
        ("stories",),
        """SELECT *, [m FOR m IN story IF m.age <= 12] AS opening,
             [m FOR m IN story IF m.age > 12 AND m.age <= 24] AS second_year FROM stories""",
    ),
    "told": (
        ("parts",),
        "SELECT vintage, LOAN_ID, " + ", ".join(f"{e} AS {c}" for c, e in _OWN.items()) + " FROM parts",
    ),
    "by_date": ((), tables.SERIES_SQL),
    "rates": (
        ("by_date",),
        """SELECT strftime(dt, '%m%Y') AS period_mmyyyy, max(dt) AS date,
             arg_max(m, dt) AS mortgage30us, arg_max(u, dt) AS unrate, arg_max(d, dt) AS dgs10, arg_max(g, dt) AS gs3m
           FROM (SELECT dt, unrate AS u,
                   last_value(mortgage30us IGNORE NULLS) OVER w AS m, last_value(dgs10 IGNORE NULLS) OVER w AS d,
                   last_value(gs3m IGNORE NULLS) OVER w AS g
                 FROM by_date WINDOW w AS (ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
           GROUP BY 1""",
    ),
    "hpi_in": ((), tables.INDEX_SQL),
    "hpi": (
        ("hpi_in",),
        """SELECT state, quarter_key, hpi_index, CASE WHEN prior > 0 THEN hpi_index / prior END - 1 AS hpi_yoy
           FROM (SELECT state, CAST(year * 10 + qtr AS INTEGER) AS quarter_key, hpi_index,
                   lag(hpi_index, 4) OVER (PARTITION BY state ORDER BY year * 10 + qtr) AS prior FROM hpi_in)""",
    ),
    "outlook": (
        ("aged", "rates", "hpi"),
        "SELECT vintage, LOAN_ID, "
        + ", ".join(f"{_known(c, 'seen', -1)} AS {c}" for c in _MACRO)
        + f""" FROM (
             SELECT vintage, LOAN_ID, list(struct_pack(
                 macro_mortgage30us := mortgage30us, macro_unrate := unrate, macro_dgs10 := dgs10,
                 macro_term_spread_10y3m := dgs10 - gs3m, hpi_state_curr := here.hpi_index,
                 hpi_state_growth_1y := here.hpi_yoy, hpi_state_orig := start.hpi_index) ORDER BY age, mi) AS seen
             FROM (SELECT *, STATE AS property_state, {_quarter('ACT_PERIOD')} AS now_quarter, {_quarter('ORIG_DATE')} AS first_quarter
                   FROM aged WHERE age <= 12)
             LEFT JOIN rates ON period_mmyyyy = ACT_PERIOD
             LEFT JOIN hpi here ON (here.state, here.quarter_key) = (property_state, now_quarter)
             LEFT JOIN hpi start ON (start.state, start.quarter_key) = (property_state, first_quarter)
             GROUP BY vintage, LOAN_ID)""",
    ),
    "loans": (("told", "outlook"), _wide(True)),
    "plain": (("told",), _wide(False)),
    "scored": (("plain",), _CARD_ROWS),
    "grp": (("scored",), f"SELECT {_KEYS}, y_score, count(*) AS n, sum(y_true) AS pos FROM scored GROUP BY {_KEYS}, y_score"),
    "cum": (
        ("grp",),
        f"""SELECT *, sum(n) OVER w AS cum_n, sum(pos) OVER w AS cum_pos,
              sum(n) OVER (PARTITION BY {_KEYS}) AS total_n, sum(pos) OVER (PARTITION BY {_KEYS}) AS total_pos
            FROM grp WINDOW w AS (PARTITION BY {_KEYS} ORDER BY y_score DESC ROWS UNBOUNDED PRECEDING)""",
    ),
    "ap": (
        ("cum",),
        f"""SELECT {_KEYS}, sum(pos * (cum_pos::DOUBLE / cum_n)) / max(total_pos) AS ap,
              sum((n - pos) * (cum_pos - pos / 2.0::DOUBLE)) /
                (max(total_pos)::DOUBLE * max(total_n - total_pos)::DOUBLE) AS auc
            FROM cum GROUP BY {_KEYS}""",
    ),
    "placed": (
        ("scored",),
        f"""SELECT *, row_number() OVER (PARTITION BY {_KEYS} ORDER BY y_score DESC, LOAN_ID) AS rk,
              count(*) OVER (PARTITION BY {_KEYS}) AS n, sum(y_true) OVER (PARTITION BY {_KEYS}) AS positives
            FROM scored""",
    ),
    "recalls": (
        ("placed",),
        f"""SELECT {_KEYS}, k, n, CAST(positives AS BIGINT) AS positives,
              CAST(greatest(ceil(k * n), 1) AS BIGINT) AS contacted,
              CAST(sum(CASE WHEN rk <= greatest(ceil(k * n), 1) THEN y_true ELSE 0 END) AS BIGINT) AS captured
            FROM placed, (SELECT unnest([0.05::DOUBLE, 0.1::DOUBLE, 0.2::DOUBLE]) AS k)
            GROUP BY {_KEYS}, k, n, positives""",
    ),
    "metrics": (
        ("ap", "recalls", "scored"),
        f"""SELECT {_KEYS}, s.n, s.prevalence, round(ap, 4) AS pr_auc, round(auc, 4) AS roc_auc, s.brier,
              r.recall_at_5pct, r.recall_at_10pct, r.recall_at_20pct
            FROM (SELECT {_KEYS}, count(*) AS n, round(avg(y_true), 4) AS prevalence,
                    round(avg((y_score - y_true) * (y_score - y_true)), 4) AS brier FROM scored GROUP BY {_KEYS}) s
            JOIN ap USING ({_KEYS})
            JOIN (SELECT {_KEYS},
                    round(max(CASE WHEN k < 0.06 THEN captured / greatest(positives, 1) END), 4) AS recall_at_5pct,
                    round(max(CASE WHEN k > 0.06 AND k < 0.11 THEN captured / greatest(positives, 1) END), 4) AS recall_at_10pct,
                    round(max(CASE WHEN k > 0.11 THEN captured / greatest(positives, 1) END), 4) AS recall_at_20pct
                  FROM recalls GROUP BY {_KEYS}) r USING ({_KEYS})""",
    ),
}


def _with(*wanted: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in _PIECES[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in wanted:
        visit(name)
    return "WITH " + ", ".join(f"{n} AS MATERIALIZED ({_PIECES[n][1]})" for n in order) + " "


def _text(value: str, digits: int) -> str:
    return f"CAST(CAST(round({value}, {digits}) AS DECIMAL(18, {digits})) AS VARCHAR)"


def _quality(contract) -> str:
    nulls = ", ".join(f"avg(CASE WHEN {n.column} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS {n.label}" for n in contract.null_limits)
    outside = ", ".join(
        f"avg(CASE WHEN {r.column} NOT BETWEEN {r.low} AND {r.high} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS oor_{r.column}"
        for r in contract.range_limits
    )
    found = [f"CASE WHEN {n.label} > {n.limit} THEN '{n.label}=' || {_text(n.label, 3)} END" for n in contract.active_null_limits()]
    found += [
        f"CASE WHEN oor_{r.column} > {r.tolerance} THEN 'oor_{r.column}=' || {_text('oor_' + r.column, 4)} END"
        for r in contract.active_range_limits()
    ]
    found += [
        f"CASE WHEN CAST(substr(vintage, 1, 4) AS INTEGER) BETWEEN {e.first_year} AND {e.last_year} "
        f"AND delinq_rate NOT BETWEEN {e.low} AND {e.high} "
        f"THEN 'delinq_rate=' || {_text('delinq_rate', 4)} || ' outside [{e.low},{e.high}]' END"
        for e in contract.eras
    ]
    shown = [n.label for n in contract.null_limits if n.enforced and n.column != "ORIG_RATE"]
    if contract.all_declared:
        shown = [n.label for n in contract.null_limits] + [f"oor_{r.column}" for r in contract.range_limits]
    rates = ", ".join(f"round({c}, 4) AS {c}" for c in ["delinq_rate", "prepay_rate", *shown])
    return f"""SELECT vintage, n_rows, n_eligible, {rates},
        CASE WHEN text = '' THEN 'OK' ELSE text END AS violations, text = '' AS passed
      FROM (SELECT *, concat_ws('; ', {', '.join(found)}) AS text
            FROM (SELECT vintage, count(*) AS n_rows, CAST(sum(eligible) AS BIGINT) AS n_eligible, {nulls}, {outside},
                    avg(CASE WHEN eligible = 1 THEN y_delinq_90p END) AS delinq_rate,
                    avg(CASE WHEN eligible = 1 THEN y_prepay END) AS prepay_rate
                  FROM loans GROUP BY vintage))"""


def _attributions() -> str:
    parts = []
    for card in FULL_CARDS:
        for t in card.terms:
            x = f"coalesce(CAST({t.feature} AS DOUBLE), {_number(t.fill)})"
            parts.append(
                f"SELECT '{card.task}' AS task, '{t.feature}' AS feature, round(avg(abs({_number(t.weight)} * "
                f"({x} - (SELECT avg({x}) FROM val)))), 6) AS mean_abs FROM val"
            )
    return " UNION ALL ".join(parts)


def _medians() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(median(CAST({c} AS DOUBLE)), 6) AS median, count(*) - count({c}) AS filled FROM train"
        for c in NUMERIC_FEATURES
    )


def _scales() -> str:
    parts = []
    for c in NUMERIC_FEATURES:
        x = f"coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM train))"
        parts.append(
            f"SELECT '{c}' AS feature, round(avg({x}), 4) AS mean, "
            f"round(CASE WHEN stddev_pop({x}) > 0 THEN stddev_pop({x}) ELSE 1 END, 4) AS scale FROM train"
        )
    return " UNION ALL ".join(parts)


def _eligible_split(source: str, split: str) -> str:
    return f"SELECT * FROM {source} WHERE eligible = 1 AND {_split('vintage')} = '{split}'"


_RATES = """count(*) AS loans, CAST(sum(eligible) AS BIGINT) AS eligible"""
_EDGES = [repr(i * (1.0 / 10)) for i in range(1, 10)]
_BIN = "(" + " + ".join(f"CASE WHEN y_score >= {e}::DOUBLE THEN 1 ELSE 0 END" for e in _EDGES) + ")"
_LEVELS = " UNION ALL ".join(
    f"SELECT split, '{c}' AS col, coalesce({c}, '__MISSING__') AS level FROM e" for c in CATEGORICAL_FEATURES
)
_COMPARED = ["pr_auc", "roc_auc", "brier", "recall_at_5pct", "recall_at_10pct", "recall_at_20pct"]
_WORDS = f"""SELECT vintage, LOAN_ID, {_month('ACT_PERIOD')} AS mi,
  {_month('ACT_PERIOD')} - lag({_month('ACT_PERIOD')}) OVER (PARTITION BY vintage, LOAN_ID ORDER BY {_month('ACT_PERIOD')}) AS step
  FROM panel"""


def _gaps(condition: str, suffix: str) -> str:
    return f"""SELECT vintage, count(DISTINCT LOAN_ID) AS loans{suffix},
        count(DISTINCT CASE WHEN step > 1 THEN LOAN_ID END) AS loans_with_gaps{suffix},
        count(*) FILTER (WHERE step > 1) AS gaps{suffix},
        CAST(coalesce(sum(step - 1) FILTER (WHERE step > 1), 0) AS BIGINT) AS missing_months{suffix},
        count(*) FILTER (WHERE step = 0) AS repeated_rows{suffix}
      FROM ({_WORDS} {condition}) GROUP BY vintage"""


ORACLES: dict[str, str] = {
    "raw_scan": _with("panel")
    + "SELECT vintage, count(*) AS rows, "
    + ", ".join(f"count({c}) AS known_{c}" for c in CORE_COLUMNS)
    + ", "
    + ", ".join(f"round(sum(CAST({c} AS DOUBLE)), 2) AS sum_{c}" for c in CORE_COLUMNS if c in _NUMBERS)
    + " FROM panel GROUP BY vintage",
    "ingest_status": _with("panel")
    + """SELECT vintage, rows, CASE WHEN CAST(substr(vintage, 6, 1) AS INTEGER) % 2 = 0 THEN 'SKIP'
           WHEN CAST(substr(vintage, 1, 4) AS INTEGER) NOT IN (1996, 1997, 1998) THEN 'FILTER' ELSE 'OK' END AS status
         FROM (SELECT vintage, count(*) AS rows FROM panel GROUP BY vintage)""",
    "ingest_convert": _with("panel")
    + """SELECT vintage, CASE WHEN wanted THEN CASE WHEN hurt THEN 'FAIL' ELSE 'OK' END ELSE 'FILTER' END AS status,
           CASE WHEN wanted THEN rows + CAST(hurt AS BIGINT) ELSE 0 END AS rows,
           CASE WHEN wanted THEN CAST(hurt AS BIGINT) ELSE 0 END AS bad_lines,
           CASE WHEN wanted AND NOT hurt THEN rows END AS stored_rows
         FROM (SELECT vintage, count(*) AS rows, vintage = '1997Q1' AS hurt,
                 CAST(substr(vintage, 1, 4) AS INTEGER) BETWEEN 1992 AND 1997 AS wanted FROM panel GROUP BY vintage)""",
    "ingest_parity": _with("panel")
    + """SELECT vintage, text_rows, stored_rows, coalesce(stored_rows, 0) - text_rows AS difference,
           CASE WHEN stored_rows IS NULL THEN 'NOT STORED' WHEN stored_rows = text_rows THEN 'OK' ELSE 'DIFFERS' END AS verdict
         FROM (SELECT vintage, count(*) + CAST(vintage = '1997Q1' AS BIGINT) AS text_rows,
                 CASE vintage WHEN '1997Q1' THEN NULL WHEN '1996Q3' THEN count(*) FILTER (CAST(LOAN_ID AS BIGINT) % 2 = 0)
                   ELSE count(*) END AS stored_rows FROM panel GROUP BY vintage)""",
    "vintage_parse": _with("panel")
    + """SELECT text, good AS valid, CASE WHEN good THEN CAST(substr(text, 1, 4) AS INTEGER) END AS year,
           CASE WHEN good THEN substr(text, 5, 2) END AS quarter
         FROM (SELECT text, regexp_matches(text, '^[0-9]{4}Q[1-4]$') AS good
               FROM (SELECT vintage AS text FROM panel UNION SELECT ACT_PERIOD FROM panel))""",
    "effective_age": _with("aged")
    + """SELECT age, late AS dlq_num, count(*) AS rows, count(*) FILTER (WHERE LOAN_AGE IS NULL) AS age_recomputed
         FROM aged GROUP BY age, late""",
    "panel_profile": _with("panel")
    + f"""SELECT vintage, rows, loans, round(rows / loans, 6) AS rows_per_loan,
           lpad(CAST((a - 1) % 12 + 1 AS VARCHAR), 2, '0') || CAST((a - 1) // 12 AS VARCHAR) AS first_period,
           lpad(CAST((b - 1) % 12 + 1 AS VARCHAR), 2, '0') || CAST((b - 1) // 12 AS VARCHAR) AS last_period,
           upb_min, upb_mean, upb_max, upb_std, age_disagreements
         FROM (SELECT vintage, count(*) AS rows, count(DISTINCT LOAN_ID) AS loans,
                 min({_month('ACT_PERIOD')}) AS a, max({_month('ACT_PERIOD')}) AS b, min(ORIG_UPB) AS upb_min,
                 round(avg(ORIG_UPB), 4) AS upb_mean, max(ORIG_UPB) AS upb_max, round(stddev_samp(ORIG_UPB), 4) AS upb_std,
                 count(*) FILTER (WHERE LOAN_AGE <> {_month('ACT_PERIOD')} - {_month('ORIG_DATE')}) AS age_disagreements
               FROM panel GROUP BY vintage)""",
    "panel_gaps": _with("panel")
    + f"SELECT * FROM ({_gaps('', '')}) a LEFT JOIN ({_gaps('WHERE CURRENT_UPB IS NOT NULL', '_reported')}) b USING (vintage)",
    "histogram": _with("panel")
    + """SELECT 'CSCORE_B' AS "column", CAST(floor(CSCORE_B / 20) * 20 AS INTEGER) AS bucket, count(*) AS n
         FROM panel WHERE CSCORE_B IS NOT NULL GROUP BY 2
         UNION ALL SELECT 'OLTV', CAST(floor(OLTV / 10) * 10 AS INTEGER), count(*)
         FROM panel WHERE OLTV IS NOT NULL GROUP BY 2""",
    "status_freq": _with("panel")
    + "SELECT DLQ_STATUS AS value, count(*) AS n FROM panel GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "exit_freq": _with("panel") + "SELECT ZB_CODE AS value, count(*) AS n FROM panel GROUP BY 1",
    "lifetime_outcome": _with("panel")
    + """SELECT outcome, count(*) AS n FROM (SELECT max(ZB_CODE) AS outcome FROM panel GROUP BY vintage, LOAN_ID)
         GROUP BY outcome""",
    "loan_sequence": _with("panel")
    + f"""SELECT LOAN_ID, array_to_string(p[1:4], ',') AS "first", array_to_string(p[-3:], ',') AS "last", len(p) AS count
         FROM (SELECT LOAN_ID, array_agg(ACT_PERIOD ORDER BY {_month('ACT_PERIOD')}) AS p FROM panel
               WHERE LOAN_ID IN (SELECT DISTINCT LOAN_ID FROM panel ORDER BY LOAN_ID LIMIT 3) GROUP BY LOAN_ID)""",
    "rowcount_parity": _with("panel")
    + f"""SELECT vintage, rows, expected_rows, rows = expected_rows AS matches
         FROM (SELECT vintage, count(*) AS rows FROM panel GROUP BY vintage)
         FULL JOIN (SELECT vintage, CAST(sum(months) AS BIGINT) AS expected_rows
                    FROM ({tables.LOAN_MONTHS_SQL}) GROUP BY vintage) USING (vintage)""",
    "orig_snapshot": _with("told") + f"SELECT vintage, LOAN_ID, {', '.join(ORIGINATION_COLUMNS)} FROM told",
    "window_features": _with("plain") + f"SELECT vintage, LOAN_ID, {_rounded(WINDOW_FEATURES)} FROM plain",
    "labels": _with("plain")
    + """SELECT vintage, LOAN_ID, y_delinq_90p, y_prepay, y_default_zb, lw_forbearance, lw_n_obs,
           CASE WHEN y_delinq_90p = 0 AND y_prepay = 0 AND lw_forbearance = 0 THEN 1 ELSE 0 END AS y_censored
         FROM plain""",
    "eligibility": _with("plain")
    + """SELECT vintage, LOAN_ID, observed_through_age, ever_terminal, first_terminal_age, eligible,
           CASE WHEN observed_through_age > 12 THEN eligible ELSE 0 END AS eligible_strict FROM plain""",
    "loan_features": _with("loans") + f"SELECT {_rounded(FEATURE_ROW_COLUMNS)} FROM loans",
    "loan_features_bucketed": _with("loans") + f"SELECT {_rounded(FEATURE_ROW_COLUMNS)} FROM loans",
    "features_no_macro": _with("plain") + f"SELECT {_rounded(FEATURE_ROW_COLUMNS)} FROM plain",
    "macro_monthly": _with("rates")
    + """SELECT period_mmyyyy, date, round(mortgage30us, 6) AS mortgage30us, round(unrate, 6) AS unrate,
           round(dgs10, 6) AS dgs10, round(gs3m, 6) AS gs3m FROM rates""",
    "hpi_yoy": _with("hpi")
    + "SELECT state, quarter_key, round(hpi_index, 6) AS hpi_index, round(hpi_yoy, 6) AS hpi_yoy FROM hpi",
    "hpi_yoy_calendar": _with("hpi")
    + """SELECT a.state, a.quarter_key, round(a.hpi_index, 6) AS hpi_index,
           round(CASE WHEN b.hpi_index > 0 THEN a.hpi_index / b.hpi_index END - 1, 6) AS hpi_yoy
         FROM hpi a LEFT JOIN hpi b ON a.state = b.state AND a.quarter_key = b.quarter_key + 10""",
    "macro_features": _with("loans") + f"SELECT vintage, LOAN_ID, {_rounded(MARKET_FEATURES)} FROM loans",
    "build_summary": _with("plain")
    + f"""SELECT {_RATES}, round(avg(CASE WHEN eligible = 1 THEN y_prepay END), 6) AS prepay_rate,
           round(avg(CASE WHEN eligible = 1 THEN y_delinq_90p END), 6) AS delinq_rate FROM plain""",
    "split_assign": _with("plain")
    + f"""SELECT LOAN_ID, vintage, CAST(substr(vintage, 1, 4) AS INTEGER) AS vintage_year,
           substr(vintage, 5, 2) AS vintage_quarter, {_split('vintage')} AS split FROM plain""",
    "split_load": _with("loans")
    + f"""SELECT vintage, LOAN_ID, {_rounded(ALL_FEATURES)}, y_delinq_90p AS y_true
          FROM ({_eligible_split('loans', 'val')})""",
    "split_summary": _with("plain")
    + f"""SELECT {_split('vintage')} AS split, {_RATES},
           CAST(sum(CASE WHEN eligible = 1 THEN y_prepay END) AS BIGINT) AS prepays,
           CAST(sum(CASE WHEN eligible = 1 THEN y_delinq_90p END) AS BIGINT) AS delinq90p,
           round(avg(CASE WHEN eligible = 1 THEN y_prepay END), 4) AS prepay_rate,
           round(avg(CASE WHEN eligible = 1 THEN y_delinq_90p END), 4) AS delinq_rate FROM plain GROUP BY 1""",
    "prevalence_by_vintage": _with("plain")
    + f"""SELECT vintage, {_RATES}, round(avg(CASE WHEN eligible = 1 THEN y_delinq_90p END), 4) AS delinq_rate,
           round(avg(CASE WHEN eligible = 1 THEN y_prepay END), 4) AS prepay_rate FROM plain GROUP BY vintage""",
    "catalog_counts": _with("panel", "plain")
    + """SELECT 'raw_monthly' AS view, count(*) AS rows FROM panel
         UNION ALL SELECT 'features', count(*) FROM plain
         UNION ALL SELECT 'features_eligible', count(*) FROM plain WHERE eligible = 1"""
    + "".join(f" UNION ALL SELECT 'features_{s}', count(*) FROM ({_eligible_split('plain', s)})" for s, _ in tables.BANDS.items()),
    "dq_report": _with("loans") + _quality(tables.CONTRACT),
    "dq_report_all_rules": _with("loans") + _quality(tables.CONTRACT_ALL),
    "dq_summary": _with("loans")
    + f"""SELECT count(*) AS vintages_checked, count(*) FILTER (WHERE passed) AS passed,
           count(*) FILTER (WHERE NOT passed) AS failed, CAST(sum(n_rows) AS BIGINT) AS total_rows,
           CAST(sum(n_eligible) AS BIGINT) AS total_eligible,
           coalesce(string_agg(vintage, ',' ORDER BY vintage) FILTER (WHERE NOT passed), '') AS failed_vintages,
           max(CASE WHEN passed THEN 0 ELSE 1 END) AS exit_status FROM ({_quality(tables.CONTRACT)})""",
    "coverage": _with("loans") + f"SELECT vintage, n_rows, n_eligible, passed FROM ({_quality(tables.CONTRACT)})",
    "drift": _with("loans") + f"SELECT vintage, delinq_rate, prepay_rate FROM ({_quality(tables.CONTRACT)})",
    "model_reload": _with("plain")
    + f"""SELECT task, split, count(*) AS loans, 0.0::DOUBLE AS off_by
         FROM (SELECT {_split('vintage')} AS split, unnest(['delinq', 'prepay']) AS task FROM plain WHERE eligible = 1)
         GROUP BY task, split""",
    "class_weights": _with("plain")
    + f""", t AS ({_eligible_split('plain', 'train')}), c AS (
           SELECT 'delinq' AS task, count(*) AS n, CAST(sum(y_delinq_90p) AS BIGINT) AS pos FROM t
           UNION ALL SELECT 'prepay', count(*), CAST(sum(y_prepay) AS BIGINT) FROM t)
         SELECT task, n, pos, round(CASE WHEN pos = 0 THEN 1 ELSE (n - pos) / pos END, 6) AS tree_weight,
           round((n - pos) / greatest(pos, 1), 6) AS network_weight FROM c""",
    "impute_medians": _with("loans") + f", train AS MATERIALIZED ({_eligible_split('loans', 'train')}) " + _medians(),
    "onehot": _with("plain")
    + f""", e AS MATERIALIZED (SELECT *, {_split('vintage')} AS split FROM plain WHERE eligible = 1),
         long AS MATERIALIZED ({_LEVELS}),
         cells AS (SELECT s.split, s.loans, k.col, k.level
                   FROM (SELECT split, count(*) AS loans FROM e GROUP BY split) s,
                        (SELECT DISTINCT col, level FROM long WHERE split = 'train') k)
         SELECT c.split, c.loans, c.col || '_' || c.level AS encoded, count(l.level) AS ones
         FROM cells c LEFT JOIN long l ON l.split = c.split AND l.col = c.col AND l.level = c.level
         GROUP BY ALL""",
    "onehot_sparse": _with("plain")
    + f""", e AS MATERIALIZED (SELECT *, {_split('vintage')} AS split FROM plain WHERE eligible = 1),
         long AS MATERIALIZED ({_LEVELS}),
         cells AS (SELECT s.split, s.loans, k.col, k.level
                   FROM (SELECT split, count(*) AS loans FROM e GROUP BY split) s,
                        (SELECT DISTINCT col, level FROM long WHERE split = 'train') k)
         SELECT c.split, c.loans, c.col || '_' || c.level AS encoded, count(l.level) AS ones
         FROM cells c LEFT JOIN long l ON l.split = c.split AND l.col = c.col AND l.level = c.level
         GROUP BY ALL""",
    "loans_by_range": _with("panel")
    + """SELECT first, last, count(*) AS rows, count(DISTINCT LOAN_ID) AS loans, true AS sketch_is_near
         FROM panel JOIN (SELECT y || 'Q1' AS first, y || 'Q4' AS last FROM range(1992, 1999) AS t(y)
                          UNION ALL VALUES ('1992Q1', '1998Q4'), ('1993Q3', '1996Q2')) ON vintage BETWEEN first AND last
         GROUP BY first, last""",
    "scaled_stats": _with("loans") + f", train AS MATERIALIZED ({_eligible_split('loans', 'train')}) " + _scales(),
    "stratified_sample": _with("plain")
    + f""", v AS (SELECT LOAN_ID, y_delinq_90p AS y_true, (CAST(LOAN_ID AS BIGINT) * 7919 + 546) % 1000003 AS h
                 FROM ({_eligible_split('plain', 'val')})),
         r AS (SELECT *, row_number() OVER (PARTITION BY y_true ORDER BY h, LOAN_ID) AS place FROM v),
         c AS (SELECT least(sum(y_true), {SAMPLE_SIZE // 2}) AS take FROM v)
         SELECT LOAN_ID, y_true FROM r, c WHERE place <= CASE WHEN y_true = 1 THEN take ELSE {SAMPLE_SIZE} - take END""",
    "scorecard": _with("scored") + "SELECT * FROM scored",
    "average_precision": _with("ap") + f"SELECT {_KEYS}, round(ap, 6) AS average_precision FROM ap",
    "roc_auc": _with("ap") + f"SELECT {_KEYS}, round(auc, 6) AS roc_auc FROM ap",
    "pr_curve": _with("cum")
    + f"""SELECT {_KEYS}, y_score AS threshold, round(cum_pos / cum_n, 6) AS precision,
           round(cum_pos / total_pos, 6) AS recall, round(total_pos / total_n, 6) AS random_precision FROM cum
         UNION ALL SELECT {_KEYS}, NULL, 1.0, 0.0, round(max(total_pos / total_n), 6) FROM cum GROUP BY {_KEYS}""",
    "roc_curve": _with("cum")
    + f"""SELECT {_KEYS}, y_score AS threshold, round((cum_n - cum_pos) / (total_n - total_pos), 6) AS fpr,
           round(cum_pos / total_pos, 6) AS tpr FROM cum
         UNION ALL SELECT DISTINCT {_KEYS}, NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM cum""",
    "recall_at_k": _with("recalls")
    + "SELECT *, round(captured / greatest(positives, 1), 6) AS recall FROM recalls",
    "calibration": _with("scored")
    + f"""SELECT {_KEYS}, round(bin / 10.0, 2)::DOUBLE AS bin_lo, round((bin + 1) / 10.0, 2)::DOUBLE AS bin_hi, count(*) AS n,
           round(CAST(avg(CAST(y_score AS DECIMAL(20, 10))) AS DECIMAL(20, 14)), 4)::DOUBLE AS mean_pred,
           round(CAST(avg(y_true) AS DECIMAL(20, 14)), 4)::DOUBLE AS mean_actual
         FROM (SELECT *, {_BIN} AS bin FROM scored) GROUP BY {_KEYS}, bin""",
    "score_metrics": _with("metrics")
    + """SELECT *, 0.05::DOUBLE AS random_recall_at_5pct, 0.1::DOUBLE AS random_recall_at_10pct,
           0.2::DOUBLE AS random_recall_at_20pct FROM metrics""",
    "joint_ap": _with("ap") + "SELECT model, split, round(avg(ap), 6) AS joint_ap FROM ap GROUP BY model, split",
    "model_compare": _with("metrics")
    + "SELECT a.task, a.split, "
    + ", ".join(f"a.{m} AS {m}_a, b.{m} AS {m}_b, round(b.{m} - a.{m}, 4) AS {m}_delta" for m in _COMPARED)
    + " FROM metrics a JOIN metrics b USING (task, split) WHERE a.model = 'full' AND b.model = 'credit'",
    "lift_funnel": _with("recalls")
    + """SELECT *, round(captured / greatest(positives, 1), 6) AS recall,
           round(captured / greatest(positives, 1) / k, 4) AS lift FROM recalls""",
    "outreach_list": _with("placed")
    + f"""SELECT {_KEYS}, rk AS rank, LOAN_ID, vintage, y_score, y_true FROM placed
         WHERE rk <= greatest(ceil(0.05::DOUBLE * n), 1)""",
    "attribution_top": _with("plain")
    + f", val AS MATERIALIZED ({_eligible_split('plain', 'val')}) SELECT * FROM ({_attributions()})",
    "attribution_compare": _with("plain")
    + f""", val AS MATERIALIZED ({_eligible_split('plain', 'val')}), a AS ({_attributions()}),
         b AS (SELECT feature, coalesce(max(CASE WHEN task = 'delinq' THEN mean_abs END), 0) AS delinq,
                 coalesce(max(CASE WHEN task = 'prepay' THEN mean_abs END), 0) AS prepay FROM a GROUP BY feature)
         SELECT feature, delinq, prepay, round(delinq + prepay, 6) AS total FROM b""",
}
