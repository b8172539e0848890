"""ANSI SQL twins of the registered queries, for checking them with another engine."""

from __future__ import annotations

import math

TX = """
lines as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
         l_shipdate, o_orderpriority, o_custkey,
         round(l_extendedprice * l_linenumber, 2) as amount,
         round(greatest(c_acctbal, cast(0 as double)) * 50, 2) as obo,
         round(greatest(s_acctbal, cast(0 as double)) * 50, 2) as obd
  from lineitem join orders on l_orderkey = o_orderkey
       join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey),
tx as (
  select concat_ws('-', cast(l_orderkey as varchar(20)), cast(l_linenumber as varchar(20)),
                   cast(l_partkey as varchar(20)), cast(l_suppkey as varchar(20)),
                   substr(cast(l_shipdate as varchar(30)), 1, 10)) as tx_id,
         cast(datediff('day', date '1992-01-01', cast(l_shipdate as date)) as int) as step,
         case when l_returnflag = 'R' and l_linestatus = 'O'
                then case when l_linenumber % 2 = 1 then 'TRANSFER' else 'CASH_OUT' end
              when o_orderpriority = '1-URGENT' then 'TRANSFER'
              when o_orderpriority = '2-HIGH' then 'CASH_OUT'
              when o_orderpriority = '3-MEDIUM' then 'PAYMENT'
              when o_orderpriority = '5-LOW' then 'CASH_IN'
              else 'DEBIT' end as type,
         amount, concat('C', cast(o_custkey as varchar(20))) as "nameOrig",
         obo as "oldbalanceOrg",
         case when l_returnflag = 'R' then cast(0 as double)
              else greatest(round(obo - amount, 2), cast(0 as double)) end as "newbalanceOrig",
         concat('M', cast(l_suppkey as varchar(20))) as "nameDest",
         obd as "oldbalanceDest",
         case when l_linestatus = 'O' then obd else round(obd + amount, 2) end
           as "newbalanceDest",
         cast(case when l_returnflag = 'R' and l_linestatus = 'O' and amount > 100000
                    and l_partkey % 10 < 9 then 1 else 0 end as int) as "isFraud",
         cast(case when l_returnflag = 'R' and l_linestatus = 'O' and l_linenumber % 2 = 1
                    and amount > 200000 then 1 else 0 end as int) as "isFlaggedFraud"
  from lines)"""

DRAINED = {
    "strict": 'cast("oldbalanceOrg" > 0 and "newbalanceOrig" = 0 as int)',
    "loose": 'case when "newbalanceOrig" = 0 then 1 else 0 end',
}


def _features(drained: str = "strict") -> str:
    return f"""{TX},
featured as (
  select *, ("oldbalanceOrg" - "newbalanceOrig") - amount as "balanceError",
         ("newbalanceDest" - "oldbalanceDest") - amount as "destBalanceError",
         cast(amount > 200000 as int) as "highValueTransaction",
         {DRAINED[drained]} as "accountDrained"
  from tx)"""


FEATURED = _features()
SCORED = f"""{FEATURED},
points as (
  select *, cast(least(
           case when "highValueTransaction" = 1 then 35 else 0 end
           + case when "accountDrained" = 1 then 30 else 0 end
           + case when amount > 200000 then 15 else 0 end
           + case when abs("balanceError") > 1000 then 10 else 0 end
           + case when abs("destBalanceError") > 1000 then 10 else 0 end, 99) as double)
           / cast(100 as double) as fraud_probability
  from featured),
risky as (
  select *, cast(case when fraud_probability >= cast(0.5 as double) then 1 else 0 end as double)
              as prediction,
         fraud_probability * cast(100 as double) as risk_score
  from points),
scored as (
  select *, case when risk_score <= 40 then 'Low Risk'
                 when risk_score <= 70 then 'Medium Risk' else 'High Risk' end as risk_level,
         case when amount < 0 then null when amount < 1000 then '<1K'
              when amount < 10000 then '1K–10K' when amount < 100000 then '10K–100K'
              when amount < 200000 then '100K–200K' when amount < 500000 then '200K–500K'
              else '500K+' end as amount_bucket,
         cast(amount as decimal(18,2)) as money
  from risky)"""

HASH = "cast(('0x' || substr(md5(tx_id), 1, 8)) as bigint)"
SAMPLE_HASH = "cast(('0x' || substr(md5('sample:' || tx_id), 1, 8)) as bigint)"
EXPORTED = (
    'tx_id, amount, "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest", '
    "prediction, fraud_probability"
)
STREAMED = "step, type, amount, prediction, fraud_probability, risk_score, risk_level"


def _with(ctes: str, query: str) -> str:
    return f"with {ctes}\n{query}"


def _count(condition: str = "true") -> str:
    return f"cast(count(*) filter (where {condition}) as bigint)"


def _rate(part: str, whole: str) -> str:
    ratio = f"cast({part} as double) / cast({whole} as double) * cast(100 as double)"
    return f"round_even({ratio}, 4)"


def _label_counts(where: str = "true", drained: str = "strict") -> str:
    return _with(
        _features(drained),
        f'select "isFraud", {_count()} as count from featured where {where} group by 1',
    )


def _fraud_by_type() -> str:
    fraud, safe = _count('"isFraud" = 1'), _count('"isFraud" = 0')
    return _with(
        FEATURED,
        f"""select type, {safe} as not_fraud, {fraud} as fraud, {_count()} as total,
       {_rate(fraud, _count())} as "fraud_rate_%"
from featured group by type""",
    )


def _kpis(source: str = "scored") -> str:
    fraud = _count("prediction = 1")
    return f"""select {_count()} as total_transactions, {fraud} as predicted_fraud,
       {_rate(fraud, _count())} as "fraud_rate_%",
       {_count("risk_level = 'High Risk'")} as high_risk_transactions,
       {_count("risk_level = 'Medium Risk'")} as medium_risk_transactions,
       cast(sum(money) as double) as total_amount,
       cast(sum(money) filter (where prediction = 1) as double) as fraud_amount,
       cast(sum(money) filter (where prediction = 1) as double) / {fraud} as avg_fraud_amount
from {source}"""


LEVEL_ROWS = "(values ('Low Risk'), ('Medium Risk'), ('High Risk')) as levels(risk_level)"
LEVEL_COUNTS = f"""select levels.risk_level, cast(count(scored.tx_id) as bigint) as transactions
from {LEVEL_ROWS} left join scored on scored.risk_level = levels.risk_level group by 1"""


def _sampled(fraction: float) -> str:
    """CTEs up to ``sampled``: every predicted fraud and the others below a hash cut."""
    return f"""{SCORED},
sampled as (
  select * from scored
  where prediction = 1
        or (prediction = 0 and {SAMPLE_HASH} < {math.ceil(fraction * 2**32)}))"""


def _sampled_exactly(fraction: float) -> str:
    return _with(
        f"""{SCORED},
ranked as (
  select *, row_number() over (partition by prediction order by {SAMPLE_HASH}, tx_id) as place,
         count(*) over (partition by prediction) as others
  from scored)""",
        f"""select {EXPORTED} from ranked
where prediction = 1 or (prediction = 0 and place <= floor({fraction} * others))""",
    )


def _bins(name: str, value: str, bins: int, low: str, high: str, source: str = "scored") -> str:
    """CTEs ``{name}_...`` ending in ``{name}``: bin, lower, upper, count for every bin."""
    edge = (
        f"case when {{i}} = {bins} then hi else cast({{i}} as double) "
        f"* ((hi - lo) / cast({bins} as double)) + lo end"
    )
    return f"""{name}_ends as (
  select {low} as lo0, {high} as hi0 from {source}),
{name}_span as (
  select lo0 - case when lo0 = hi0 then cast(0.5 as double) else cast(0 as double) end as lo,
         hi0 + case when lo0 = hi0 then cast(0.5 as double) else cast(0 as double) end as hi
  from {name}_ends),
{name}_edges as (
  select cast(i as int) as bin, {edge.format(i="i")} as lower, {edge.format(i="(i + 1)")} as upper
  from {name}_span, range({bins}) as r(i)),
{name} as (
  select bin, lower, upper, cast(count(x) as bigint) as count
  from {name}_edges left join (select {value} as x from {source}) as v
       on x >= lower and (x < upper or (bin = {bins - 1} and x = upper))
  group by 1, 2, 3)"""


def _simple_bins(value: str, bins: int, source: str = "scored") -> str:
    return _bins("h", value, bins, f"min({value})", f"max({value})", source)


CENTRED = "select bin, (lower + upper) / cast(2 as double) as center, count from h"
TAIL = """tail as (
  select * from scored
  where fraud_probability > (
    select case when count(*) filter (where fraud_probability > cast(0.3 as double)) > 0
                then cast(0.3 as double) else avg(fraud_probability) end from scored))"""
TOP_AMOUNT = "log10(greatest(max(amount), cast(10 as double)))"


def _log_bins(name: str, prediction: int) -> str:
    value = (
        f"case when prediction = {prediction} "
        "then log10(greatest(amount, cast(1 as double))) end"
    )
    return _bins(name, value, 59, "cast(0 as double)", TOP_AMOUNT)


def _distributions() -> str:
    names = {
        "fraud_probability": _bins(
            "p", "fraud_probability", 40, "min(fraud_probability)", "max(fraud_probability)"
        ),
        "fraud_probability_tail": _bins(
            "t", "fraud_probability", 30, "min(fraud_probability)", "max(fraud_probability)",
            "tail",
        ),
        "risk_score": _bins("s", "risk_score", 40, "min(risk_score)", "max(risk_score)"),
        "log10_amount_not_fraud": _log_bins("a0", 0),
        "log10_amount_fraud": _log_bins("a1", 1),
    }
    selects = [
        f"select '{label}' as histogram, bin, round_even(lower, 6) as lower, "
        f"round_even(upper, 6) as upper, count from {cte.split('_ends')[0]}"
        for label, cte in names.items()
    ]
    ctes = ",\n".join([SCORED, TAIL, *names.values()])
    return _with(ctes, "\nunion all\n".join(selects))


def _label_reports_over(source: str) -> str:
    parts = {
        "fraud_vs_normal": ("cast(null as varchar)", "true"),
        "fraud_by_type": ("type", "true"),
        "high_value_fraud": ("cast(null as varchar)", '"highValueTransaction" = 1'),
        "account_drained_cases": ("cast(null as varchar)", '"accountDrained" = 1'),
    }
    return "\nunion all\n".join(
        f"select '{name}' as report, {kind} as type, \"isFraud\", {_count()} as count "
        f"from {source} where {where} group by 1, 2, 3"
        for name, (kind, where) in parts.items()
    )


def _label_reports() -> str:
    return _with(FEATURED, _label_reports_over("featured"))


def _bi_marts() -> str:
    fraud = _count("prediction = 1")
    amount = "cast(sum(money) as double)"
    return _with(
        SCORED,
        f"""select 'summary_kpis' as mart, 'all' as item, {_count()} as transactions,
       {fraud} as fraud, {amount} as total_amount from scored
union all
select 'risk_level_summary', risk_level, {_count()}, cast(null as bigint), {amount}
from scored group by risk_level
union all
select 'amount_buckets', amount_bucket, {_count()}, {fraud}, cast(null as double)
from scored where amount_bucket is not null group by amount_bucket
union all
select 'transactions_scored', 'all', {_count()}, {fraud}, {amount} from scored
union all
select 'fraud_by_type', type, {_count()}, {_count('"isFraud" = 1')}, cast(null as double)
from scored group by type""",
    )


def oracle_queries(sample_fraction: float) -> dict[str, str]:
    drained = '"accountDrained" = 1'
    features = (
        'tx_id, amount, "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest", '
        '"balanceError", "destBalanceError", "highValueTransaction", "accountDrained"'
    )
    scores = "prediction, fraud_probability, risk_score, risk_level"
    split = f"case when {HASH} < 3435973837 then 'train' else 'test' end as split"
    by_rank = """
ranks as (
  select cast("isFraud" as double) as y,
         rank() over (order by fraud_probability)
         + (count(*) over (partition by fraud_probability) - 1) / cast(2 as double) as r
  from scored)"""
    exported = f"select {EXPORTED} from sampled"
    marked = f"{TX},\nmarked as (select *, {split} from tx)"
    none = "cast(0 as bigint) as wrong"
    held_out = _with(marked, f"select {_count()} as rows, {none}, true as ranks_well from marked where split = 'test'")
    every_row = _with(TX, f"select {_count()} as rows, {none} from tx")
    return {
        "transactions": _with(TX, "select * from tx"),
        "event_round_trip": _with(TX, "select * exclude (tx_id) from tx"),
        "features_strict": _with(FEATURED, f"select {features} from featured"),
        "features_loose": _with(_features("loose"), f"select {features} from featured"),
        "rule_scores": _with(SCORED, f"select tx_id, {scores} from scored"),
        "amount_bucket_rows": _with(SCORED, "select tx_id, amount, amount_bucket from scored"),
        "predicted_frauds": _with(
            SCORED, "select tx_id, amount, risk_level from scored where prediction = 1"
        ),
        "risk_projection": _with(SCORED, f"select {scores} from scored"),
        "export_projection": _with(SCORED, f"select {EXPORTED}, type from scored"),
        "stream_projection": _with(SCORED, f"select {STREAMED} from scored"),
        "row_count": _with(TX, f"select {_count()} as count from tx"),
        "fraud_vs_normal": _label_counts(),
        "fraud_by_type_long": _with(
            FEATURED, f'select type, "isFraud", {_count()} as count from featured group by 1, 2'
        ),
        "high_value_fraud": _label_counts('"highValueTransaction" = 1'),
        "account_drained_cases": _label_counts(drained),
        "account_drained_cases_loose": _label_counts(drained, "loose"),
        "label_reports": _label_reports(),
        "fraud_by_type": _fraud_by_type(),
        "fraud_by_type_by_total": _fraud_by_type() + " order by total desc, type",
        "fraud_by_type_by_rate": _fraud_by_type() + ' order by "fraud_rate_%" desc, type',
        "fraud_by_type_from_counts": _fraud_by_type(),
        "summary_kpis": _with(SCORED, _kpis()),
        "risk_level_summary": _with(
            SCORED,
            f"""select risk_level, {_count()} as transactions,
       cast(sum(money) as double) as total_amount,
       cast(sum(money) as double) / count(*) as avg_amount
from scored group by risk_level""",
        ),
        "amount_buckets": _with(
            SCORED,
            f"""select amount_bucket, {_count()} as transactions,
       {_count("prediction = 1")} as fraud,
       {_rate(_count("prediction = 1"), _count())} as "fraud_rate_%"
from scored where amount_bucket is not null group by amount_bucket""",
        ),
        "predicted_class_counts": _with(
            SCORED, f"select prediction, {_count()} as count from scored group by 1"
        ),
        "risk_level_counts": _with(SCORED, LEVEL_COUNTS),
        "sample_kpis": _with(
            SCORED,
            f"""select total_transactions as transactions, predicted_fraud, "fraud_rate_%",
       high_risk_transactions from ({_kpis("scored")}) as k""",
        ),
        "bi_marts": _bi_marts(),
        "top_risk": _with(
            SCORED,
            "select tx_id, type, amount, risk_score from scored "
            "order by risk_score desc, tx_id limit 50",
        ),
        "probability_histogram": _with(
            f"{SCORED},\n{_simple_bins('fraud_probability', 40)}", CENTRED
        ),
        "tail_histogram": _with(
            f"{SCORED},\n{TAIL},\n{_simple_bins('fraud_probability', 30, 'tail')}", CENTRED
        ),
        "risk_score_histogram": _with(f"{SCORED},\n{_simple_bins('risk_score', 40)}", CENTRED),
        "amount_histogram": _with(f"{SCORED},\n{_simple_bins('amount', 40)}", CENTRED),
        "amount_log_histogram": _with(
            ",\n".join([SCORED, _log_bins("a0", 0), _log_bins("a1", 1)]),
            "\nunion all\n".join(
                f"select cast({c} as double) as prediction, bin, "
                f"round_even(pow(cast(10 as double), lower), 4) as lower, count from a{c}"
                for c in (0, 1)
            ),
        ),
        "distributions": _distributions(),
        "split_by_key": _with(TX, f"select tx_id, {split} from tx"),
        "split_counts": _with(
            TX, f'select {split}, "isFraud", {_count()} as count from tx group by 1, 2'
        ),
        "fact_table": _with(SCORED, f"select {EXPORTED} from scored"),
        "downsample_by_hash": _with(_sampled(sample_fraction), exported),
        "downsample_exact": _sampled_exactly(sample_fraction),
        "head_transactions": _with(
            TX, "select cast(count(*) // 10 as bigint) as rows, cast(0 as bigint) as unknown from tx"
        ),
        "csv_round_trip": _with(
            TX, f'select type, "isFraud", {_count()} as count from tx group by type, "isFraud"'
        ),
        "model_comparison": "select model, true as ranks_well from (values "
        "('Logistic Regression'), ('Random Forest'), ('Gradient Boosted Trees')) as m(model)",
        "training_job": _with(
            f"{FEATURED},\nreports as ({_label_reports_over('featured')}),\n"
            f"marked as (select *, {split} from tx)",
            f"""select report as item, {_count()} as rows, cast(sum(count) as bigint) as total
from reports group by report
union all
select 'final_risk_scores', {_count()}, {_count()} from marked where split = 'test'
union all
select model, cast(1 as bigint), cast(1 as bigint) from (values
  ('Logistic Regression'), ('Random Forest'), ('Gradient Boosted Trees')) as m(model)""",
        ),
        "export_kpis": _with(SCORED, _kpis()),
        "dead_letters": _with(
            TX,
            f"""select 'received' as outcome, {_count()} as messages from tx
union all
select case {HASH} % 97 when 0 then 'malformed' when 1 then 'empty' when 2 then 'bad_value'
            when 3 then 'missing_input' else 'scored' end, {_count()} from tx group by 1""",
        ),
        "csv_rejects": _with(
            TX,
            f"""select 'lines' as item, {_count()} as rows, cast(null as double) as total_amount from tx
union all
select 'accepted', {_count()}, cast(sum(cast(amount as decimal(18,2))) as double) from tx where {HASH} % 97 > 1
union all
select 'rejected', {_count()}, cast(null as double) from tx where {HASH} % 97 < 2""",
        ),
        "bare_model_scores": _with(
            marked, f"select cast(3 * count(*) as bigint) as rows, {none} from marked where split = 'test'"
        ),
        **{name: held_out for name in ("logistic_scores", "forest_scores", "gbt_scores")},
        **{
            name: every_row
            for name in (
                "adhoc_scores", "stream_model_scores", "export_job", "live_job", "split_random",
                "gbt_summary_kpis", "gbt_risk_level_summary", "gbt_amount_buckets",
                "gbt_probability_histogram",
            )
        },
        "model_coverage": _with(
            f"{TX},\nmarked as (select *, {split} from tx)",
            f"""select model, {_count()} as transactions, {_count('"isFraud" = 1')} as frauds,
       cast(sum(cast(amount as decimal(18,2))) as double) as total_amount
from marked, (values ('lr'), ('rf'), ('gbt')) as models(model)
where split = 'test' group by model""",
        ),
        "gbt_conservation": _with(
            TX,
            f"""select mart, {_count()} as transactions,
       case when mart <> 'histogram'
            then cast(sum(cast(amount as decimal(18,2))) as double) end as total_amount
from tx, (values ('kpis'), ('levels'), ('histogram')) as marts(mart) group by mart""",
        ),
        "rule_auc": _with(
            f"{SCORED},{by_rank}",
            """select round((sum(r) filter (where y = 1)
              - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 6) as auc
from ranks""",
        ),
        "stream_rule_scores": _with(SCORED, f"select tx_id, {STREAMED} from scored"),
        "stream_fanout": _with(
            SCORED,
            f"select sink, risk_level, transactions from ({LEVEL_COUNTS}) as n, "
            "(values ('csv'), ('parquet')) as sinks(sink)",
        ),
    }
