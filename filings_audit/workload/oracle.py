"""SQL building blocks, written for DuckDB over the same tables."""

from __future__ import annotations

from filings_audit.functions.identity import URL_NAMESPACE_HEX
from filings_audit.functions.patterns import PII_PATTERNS, placeholder
from filings_audit.functions.shaping import ASSIGNEES, MODEL_VERSION, SEVERITY_RANK, STATUS_RANK
from filings_audit.operators.explain import MODEL_TEXTS, RULE_TEXTS
from filings_audit.sources.star_schema import FORM_BY_PRIORITY


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(quote(v) for v in values) + ")"


def case(subject: str, options: dict, otherwise: str | None = None) -> str:
    body = " ".join(f"WHEN {quote(str(k))} THEN {quote(v) if isinstance(v, str) else v}" for k, v in options.items())
    return f"CASE {subject} {body}{'' if otherwise is None else ' ELSE ' + otherwise} END"


def md5_mod(text: str, modulus: int) -> str:
    acc = "0"
    for i in range(8):
        word = f"CAST('0x' || substr(md5({text}), {1 + 4 * i}, 4) AS INTEGER)"
        acc = f"(({acc} * {65536 % modulus} + {word}) % {modulus})"
    return acc


def uuid5(name: str) -> str:
    h = f"sha1(unhex('{URL_NAMESPACE_HEX}') || encode({name}))"
    variant = f"substr('89ab', CAST('0x' || substr({h}, 17, 1) AS INTEGER) % 4 + 1, 1)"
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
        f"{variant} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"
    )


def sha256(text: str, salt: str) -> str:
    return f"sha256({quote(salt + ':')} || {text})"


def redact(text: str, types) -> list[str]:
    """The text after 0, 1, 2, ... of the types have been applied."""
    states = [text]
    for name in PII_PATTERNS:
        if name in types:
            states.append(
                f"regexp_replace({states[-1]}, {quote(PII_PATTERNS[name].regex)}, {quote(placeholder(name))}, 'g')"
            )
    return states


def staged_redaction(source: str, columns: str, text: str, types, prefix: str = "r") -> str:
    """CTEs ``r0 .. rn``; each ``rk`` has ``t`` after k types and ``h1 .. hk`` for what each one changed."""
    names = [n for n in PII_PATTERNS if n in types]
    parts = [f"{prefix}0 AS (SELECT {columns}, {text} AS t FROM {source})"]
    for k, name in enumerate(names, 1):
        keep = ", ".join(f"h{j}" for j in range(1, k))
        new = f"regexp_replace(t, {quote(PII_PATTERNS[name].regex)}, {quote(placeholder(name))}, 'g')"
        hit = f"regexp_matches(t, {quote(PII_PATTERNS[name].regex)}) AS h{k}"
        parts.append(f"{prefix}{k} AS (SELECT {columns}, {new} AS t, {keep + ', ' if keep else ''}{hit} FROM {prefix}{k - 1})")
    return ",\n".join(parts)


def text_number(value: str, places: int) -> str:
    return f"CAST(CAST(round(CAST({value} AS DECIMAL(30,10)), {places}) AS DECIMAL(30,{places})) AS VARCHAR)"


FILINGS = f"""
filings AS (
  SELECT o_orderkey AS order_key, CAST(o_orderkey AS VARCHAR) AS id, c_name AS company_name,
    lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik,
    {case("substr(o_orderpriority, 1, 1)", FORM_BY_PRIORITY)} AS form_type,
    CAST(o_orderdate AS DATE) AS filing_date,
    CAST(o_totalprice * 1e4 AS DECIMAL(20,2)) AS revenue_usd,
    o_totalprice / lag(o_totalprice) OVER (
      PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) - 1 AS revenue_growth,
    CAST(c_acctbal * 1e6 AS DECIMAL(20,2)) AS operating_cash_flow,
    CASE WHEN o_orderkey % 5 <> 0 THEN 'Exec ' || o_custkey END AS executive_name,
    o_orderstatus AS filing_state, c_mktsegment AS segment,
    o_orderdate + to_seconds(o_orderkey % 86400) AS created_at
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""

SCORED = FILINGS + """,
stats AS (SELECT avg(revenue_growth) AS mean, stddev_samp(revenue_growth) AS std FROM filings),
scored AS (
  SELECT f.*, (revenue_growth - mean) / (std + 1e-9) AS z,
    coalesce(CAST(operating_cash_flow AS DOUBLE), 0) / 1e10 AS cf,
    0.0 - round(least(abs(coalesce((revenue_growth - mean) / (std + 1e-9), 0.0)) / 5, 1.0), 4) AS raw
  FROM filings f, stats)"""

RULE = "(coalesce(revenue_growth, 0) > 0.2 AND coalesce(operating_cash_flow, 0) < 0)"


def triage(contamination: float = 0.08) -> str:
    return SCORED + f""",
limits AS (
  SELECT quantile_cont(raw, {contamination}) AS threshold, min(0.0 - raw) AS low, max(0.0 - raw) AS high FROM scored),
triage AS (
  SELECT s.*, {RULE} AS known_rule_violation, raw < threshold AS ml_anomaly_flag,
    round((0.0 - raw - low) / (high - low + 1e-9), 4) AS ml_anomaly_score
  FROM scored s, limits)"""


def _message() -> str:
    numbers = {
        "growth": text_number("CAST(coalesce(revenue_growth, 0) AS DECIMAL(28,10)) * 100", 1),
        "sigma": text_number("abs(coalesce(z, 0))", 1),
        "ratio": text_number("abs(cf)", 3),
        "score": text_number("ml_anomaly_score", 2),
    }

    def fill(template: str) -> str:
        pieces, rest = [], template
        while "{" in rest:
            before, _, rest = rest.partition("{")
            name, _, rest = rest.partition("}")
            pieces += [quote(before), numbers[name]]
        return " || ".join([*pieces, quote(rest)])

    def choose(options: list[str]) -> str:
        body = " ".join(f"WHEN {i} THEN {option}" for i, option in enumerate(options))
        return f"CASE {md5_mod('id', len(options))} {body} END"

    return (
        f"CASE WHEN known_rule_violation THEN {choose([quote(t) for t in RULE_TEXTS])} "
        f"WHEN ml_anomaly_flag THEN {choose([fill(t) for t in MODEL_TEXTS])} END"
    )


MESSAGE = _message()
GOLD = triage() + f""",
gold AS (SELECT *, {MESSAGE} AS root_cause_message FROM triage)"""

HEAD = "split_part(id, '-', 1)"
ROUTE = (
    f"coalesce(CASE WHEN regexp_matches({HEAD}, '^[0-9]{{1,38}}$') THEN TRY_CAST({HEAD} AS DECIMAL(38,0)) END, "
    f"{md5_mod('id', 10000)})"
)
ASSIGNEE = f"[{', '.join(quote(a) for a in ASSIGNEES)}][CAST({ROUTE} % {len(ASSIGNEES)} AS INTEGER) + 1]"
AGE_HOURS = (
    f"greatest(1, ({md5_mod('id', 1000)} * 11 + CAST(trunc(ml_anomaly_score * 137) AS INTEGER)) % 193)"
)
CLUSTER = (
    "CASE WHEN ml_anomaly_score >= 0.8 THEN 'Cluster-7 (High-Risk)' "
    "WHEN ml_anomaly_score >= 0.5 THEN 'Cluster-3 (Medium-Risk)' ELSE 'Cluster-2 (Low-Risk)' END"
)
LOW = "CAST(round(greatest(CAST(0 AS DECIMAL(10,4)), CAST(ml_anomaly_score AS DECIMAL(10,4)) - 0.04), 2) AS DECIMAL(10,2))"
HIGH = "CAST(round(least(CAST(1 AS DECIMAL(10,4)), CAST(ml_anomaly_score AS DECIMAL(10,4)) + 0.04), 2) AS DECIMAL(10,2))"
REVENUE = (
    "'$' || CAST(round(operating_cash_flow * CAST(0.000000001 AS DECIMAL(10,9)), 1) AS DECIMAL(30,1)) || 'B'"
)
RATIO = "CAST(CAST(round(coalesce(operating_cash_flow, 0) * CAST(0.0000000001 AS DECIMAL(11,10)), 3) AS DECIMAL(20,3)) AS DOUBLE)"
GROWTH3 = "CAST(round(CAST(coalesce(revenue_growth, 0) AS DECIMAL(30,10)), 3) AS DOUBLE)"
SHARE = "CAST(round(CAST(ml_anomaly_score AS DECIMAL(10,4)) * CAST(0.3 AS DECIMAL(2,1)), 3) AS DOUBLE)"


def by_flag(rule: str, ml: str, neither: str) -> str:
    return (
        f"CASE WHEN known_rule_violation THEN {quote(rule)} WHEN ml_anomaly_flag THEN {quote(ml)} "
        f"ELSE {quote(neither)} END"
    )


SEVERITY = by_flag("violation", "anomaly", "healthy")
NEEDS = "(known_rule_violation OR ml_anomaly_flag)"

RECORDS = GOLD + f""",
aged AS (SELECT *, {AGE_HOURS} AS hours FROM gold),
records AS (
  SELECT id, company_name AS company, strftime(filing_date, '%Y-%m-%d') AS filing_date,
    {by_flag("Rule Violation", "ML Anomaly", "None")} AS issue_type, {SEVERITY} AS severity,
    cik, form_type, {REVENUE} AS revenue, known_rule_violation AS rule, ml_anomaly_flag AS ml,
    {NEEDS} AS needs_triage, {by_flag("Needs Review", "In Progress", "Resolved")} AS status,
    CASE WHEN {NEEDS} THEN {ASSIGNEE} END AS assignee,
    CASE WHEN {NEEDS} THEN CASE WHEN hours < 24 THEN hours || 'h' ELSE (hours // 24) || 'd' END END AS alert_age,
    root_cause_message AS details, ml_anomaly_score AS score, {CLUSTER} AS cluster,
    strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ingestion_ts, {quote(MODEL_VERSION)} AS model_version,
    {GROWTH3} AS growth_delta, {RATIO} AS cash_ratio, {SHARE} AS frequency,
    CAST({LOW} AS VARCHAR) || ' – ' || CAST({HIGH} AS VARCHAR) AS interval_text, created_at
  FROM aged)"""

TOKEN_HOURS = (
    "coalesce(CASE WHEN regexp_matches(alert_age, '^[0-9]+h$') THEN TRY_CAST(left(alert_age, -1) AS INTEGER) "
    "WHEN regexp_matches(alert_age, '^[0-9]+d$') THEN TRY_CAST(left(alert_age, -1) AS INTEGER) * 24 END, 0)"
)
SORT_SQL = {
    "company": "company",
    "formType": "form_type",
    "filingDate": "filing_date",
    "issueType": case("severity", SEVERITY_RANK, "9"),
    "status": case("status", STATUS_RANK, "9"),
    "anomalyScore": "coalesce(score, 0)",
    "rootCause": "coalesce(details, '')",
    "assignee": "coalesce(assignee, '')",
    "alertAge": TOKEN_HOURS,
}
