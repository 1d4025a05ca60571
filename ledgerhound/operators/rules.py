"""Detection rules R001..R008 (O-21..O-30).

Every rule emits the alert grain ``(rule_id, customer_key, date_key)`` with
``alert_id, trigger_amount, trigger_txn_count, detail``.

Time windows are RANGE frames (peers in the same hour/day share a frame), so
each rule first collapses its input to one row per (key, hour) or (key, day).
That yields the identical alerts and bounds a hot customer or account at 24
rows a day, whatever its transaction count; the window then only sorts those
compact rows inside ``partitionBy(customer_key | account_key)``.

Rules that share a key run as one plan: ``customer_window_rules`` evaluates
R001/R002/R006/R008 with one scan and one customer shuffle, and
``customer_day_rules`` does the same for R004/R005. The ``rule_r00n``
functions are the one-rule case of the same code, so the per-rule queries and
the alert table are checked against the same oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import MONEY, real_text
from ..params import RuleParams

ALERT_COLUMNS = ["alert_id", "rule_id", "customer_key", "date_key", "trigger_amount",
                 "trigger_txn_count", "detail"]

# The reference's rule catalogue (dim_rule).
RULE_CATALOGUE = [
    ("R001", "Near-threshold cash clustering", "structuring", "threshold", "high",
     "Three or more cash credits in the 8,000-9,999 band by one customer within a rolling 48-hour window."),
    ("R002", "LCTR aggregation avoidance", "structuring", "threshold", "high",
     "Cash credits summing to 10,000 or more within 24 hours where no single transaction reaches the reporting threshold."),
    ("R003", "Rapid movement of funds", "rapid_movement", "flow", "high",
     "Inbound credit of 15,000 or more where 80 percent or more exits the account within 72 hours."),
    ("R004", "High-risk jurisdiction wire", "layering", "geography", "medium",
     "Wire transfer of 5,000 or more to or from a jurisdiction on the high-risk list."),
    ("R005", "Volume velocity spike", "general", "behavioural", "medium",
     "Rolling 30-day credit volume exceeds three times the customer prior 90-day daily average."),
    ("R006", "Round-value transfer clustering", "layering", "pattern", "medium",
     "Three or more round-thousand wire or e-transfer movements of 5,000 or more within seven days."),
    ("R007", "Dormant account reactivation", "general", "behavioural", "low",
     "Account with no activity for 60 or more days followed by 25,000 or more of throughput within seven days."),
    ("R008", "Sustained near-threshold cash", "structuring", "threshold", "medium",
     "Five or more cash credits in the 8,000-9,999 band by one customer within a rolling 30-day window."),
]
RULE_COLUMNS = ["rule_id", "rule_name", "typology_target", "rule_family", "severity", "rule_description"]


def _short(amount) -> str:
    """8000 -> 8k, 9999.99 -> 9,999."""
    whole = int(amount)
    return f"{whole // 1000}k" if whole and whole % 1000 == 0 else f"{whole:,}"


def detail_prefix(rule_id: str, p: RuleParams) -> str:
    """The text before an alert's figure; windows and bands are those of the parameters."""
    return {
        "R001": f"cash credits in {_short(p.r001_band_low)}-{_short(p.band_high)} band within {p.r001_hours}h: ",
        "R002": f"aggregated cash credits within {p.r002_hours}h: $",
        "R003": "pass-through ratio ",
        "R004": "wire activity with high-risk jurisdiction: ",
        "R005": f"rolling {p.r005_window_days}d credit volume ",
        "R006": f"round-value transfers in {p.r006_hours / 24:g}d: ",
        "R007": "reactivated after ",
        "R008": f"band cash credits in {p.r008_days}d: ",
    }[rule_id]


def detail_suffix(rule_id: str, p: RuleParams) -> str:
    return {"R003": f"% within {p.r003_hours}h", "R005": f"x the prior {p.r005_baseline_from - p.r005_baseline_to + 1}d baseline",
            "R007": " dormant days"}.get(rule_id, "")


def rule_dim(spark) -> DataFrame:
    """dim_rule (O-03): the 8 literal rows."""
    return spark.createDataFrame(RULE_CATALOGUE, RULE_COLUMNS)


def _alert(rule_id: str, amount: Column, count: Column, detail: Column) -> list[Column]:
    return [
        F.concat(F.lit(rule_id + "-"), F.col("customer_key").cast("string"), F.lit("-"),
                 F.col("date_key").cast("string")).alias("alert_id"),
        F.lit(rule_id).alias("rule_id"),
        F.col("customer_key").cast("long").alias("customer_key"),
        F.col("date_key").cast("int").alias("date_key"),
        amount.cast("double").alias("trigger_amount"),
        count.cast("long").alias("trigger_txn_count"),
        detail.alias("detail"),
    ]


def _hour_idx() -> Column:
    return F.col("date_key") * 24 + F.col("hour_of_day")


def _cash_credit() -> Column:
    return (F.col("channel") == "cash") & (F.col("direction") == "credit")


@dataclass(frozen=True)
class CustomerWindowRule:
    """A rule that counts and sums one customer's qualifying transactions over a
    trailing RANGE frame of ``span`` hours or days (R001, R002, R006, R008).

    ``rows`` picks the transactions the rule looks at; ``keep(cnt, amt, mx)``
    tests the frame totals; ``detail(amt, cnt)`` renders the alert text from the
    per-(customer, date) maxima.
    """
    rule_id: str
    rows: Column
    unit: str  # "hour" or "day"
    span: int
    keep: Callable[[Column, Column, Column], Column]
    detail: Callable[[Column, Column], Column]


def customer_window_rules(fact: DataFrame, specs: list[CustomerWindowRule]) -> DataFrame:
    """Evaluate several customer-window rules in one scan and one shuffle.

    1. One pass over the fact keeps the rows any rule looks at and collapses
       them to (customer, hour) with a count, a sum and a max *per rule*
       (conditional aggregates, combined map-side). Peers in an hour share
       every frame, so this gives the rule's alerts unchanged and bounds a hot
       customer at 24 rows a day.
    2. Every rule's frame runs over ``partitionBy(customer_key)``: hour frames
       order by the hour index, day frames by ``date_key``; both reuse the one
       exchange on ``customer_key`` (a day frame only adds a sort).
    3. Each hour row that holds the rule's own transactions and passes its test
       becomes one (rule, customer, date) candidate; ``explode`` + ``groupBy``
       take the maxima per alert grain.
    """
    if not specs:
        raise ValueError("customer_window_rules needs at least one rule spec")
    any_rule = reduce(lambda a, b: a | b, [s.rows for s in specs])
    aggs = []
    for i, s in enumerate(specs):
        amt = F.when(s.rows, F.col("amount_cad"))
        aggs += [F.count(F.when(s.rows, F.lit(1))).alias(f"_n{i}"), F.sum(amt).alias(f"_a{i}"),
                 F.max(amt).alias(f"_m{i}")]
    hourly = fact.filter(any_rule).groupBy("customer_key", "date_key", "hour_of_day").agg(*aggs)

    cands, hits = [], []
    for i, s in enumerate(specs):
        order = _hour_idx() if s.unit == "hour" else F.col("date_key")
        w = Window.partitionBy("customer_key").orderBy(order).rangeBetween(-(s.span - 1), Window.currentRow)
        cnt, amt, mx = (F.sum(f"_n{i}").over(w), F.sum(f"_a{i}").over(w), F.max(f"_m{i}").over(w))
        hit = F.coalesce((F.col(f"_n{i}") > 0) & s.keep(cnt, amt, mx), F.lit(False))
        hits.append(hit)
        cands.append(F.when(hit, F.struct(F.lit(s.rule_id).alias("rule_id"), amt.alias("a"),
                                          cnt.alias("c"))))
    # Window expressions cannot sit inside a generator: build the array first,
    # drop rows without any hit, then explode (all compiled, no per-row lambda).
    x = (hourly.select("customer_key", "date_key", F.array(*cands).alias("_c"),
                       reduce(lambda a, b: a | b, hits).alias("_any"))
         .filter("_any")
         .select("customer_key", "date_key", F.explode("_c").alias("_x"))
         .filter(F.col("_x").isNotNull()))
    g = x.groupBy("_x.rule_id", "customer_key", "date_key").agg(F.max("_x.a").alias("a"),
                                                                F.max("_x.c").alias("c"))
    detail = None
    for s in specs:
        d = s.detail(F.col("a"), F.col("c"))
        detail = F.when(F.col("rule_id") == s.rule_id, d) if detail is None else detail.when(
            F.col("rule_id") == s.rule_id, d)
    return g.select(
        F.concat(F.col("rule_id"), F.lit("-"), F.col("customer_key").cast("string"), F.lit("-"),
                 F.col("date_key").cast("string")).alias("alert_id"),
        "rule_id",
        F.col("customer_key").cast("long").alias("customer_key"),
        F.col("date_key").cast("int").alias("date_key"),
        F.col("a").cast("double").alias("trigger_amount"),
        F.col("c").cast("long").alias("trigger_txn_count"),
        detail.alias("detail"))


def spec_r001(p: RuleParams = RuleParams()) -> CustomerWindowRule:
    return CustomerWindowRule(
        "R001", _cash_credit() & F.col("amount_cad").between(p.r001_band_low, p.band_high), "hour", p.r001_hours,
        lambda cnt, amt, mx: cnt >= p.r001_min_count,
        lambda a, c: F.concat(F.lit(detail_prefix("R001", p)), c.cast("string")))


def spec_r002(p: RuleParams = RuleParams()) -> CustomerWindowRule:
    return CustomerWindowRule(
        "R002", _cash_credit(), "hour", p.r002_hours,
        lambda cnt, amt, mx: (amt >= p.r002_threshold) & (mx < p.r002_threshold) & (cnt >= p.r002_min_count),
        lambda a, c: F.concat(F.lit(detail_prefix("R002", p)),
                              real_text(F.round(a, 0))))


def spec_r006(p: RuleParams = RuleParams()) -> CustomerWindowRule:
    whole = F.floor(F.col("amount_cad"))
    rows = (F.col("channel").isin(*p.r006_channels) & (F.col("amount_cad") >= p.r006_min_amount)
            & (whole % p.r006_unit == 0) & (F.col("amount_cad") == whole))
    return CustomerWindowRule(
        "R006", rows, "hour", p.r006_hours,
        lambda cnt, amt, mx: cnt >= p.r006_min_count,
        lambda a, c: F.concat(F.lit(detail_prefix("R006", p)), c.cast("string")))


def spec_r008(p: RuleParams = RuleParams()) -> CustomerWindowRule:
    return CustomerWindowRule(
        "R008", _cash_credit() & F.col("amount_cad").between(p.band_low, p.band_high), "day", p.r008_days,
        lambda cnt, amt, mx: cnt >= p.r008_min_count,
        lambda a, c: F.concat(F.lit(detail_prefix("R008", p)), c.cast("string")))


def customer_window_specs(p: RuleParams = RuleParams()) -> list[CustomerWindowRule]:
    return [spec_r001(p), spec_r002(p), spec_r006(p), spec_r008(p)]


def rule_r001(fact: DataFrame, p: RuleParams = RuleParams()) -> DataFrame:
    """Band cash clustering: RANGE 47 preceding hours, count >= 3."""
    return customer_window_rules(fact, [spec_r001(p)])


def rule_r002(fact: DataFrame, p: RuleParams = RuleParams()) -> DataFrame:
    """Sub-threshold aggregation: 24-hour cash sum over the threshold, no single
    transaction at it, at least two transactions."""
    return customer_window_rules(fact, [spec_r002(p)])


EVENT, DETECTION = "event", "detection"


def _first_reached(steps: Column, target: Column) -> Column:
    """The first (at, total, n) at which the running total of ``steps``, an array of (at, amount, n) by time, reaches ``target``; else null."""
    none = F.struct(F.lit(None).cast("int").alias("at"), F.lit(0).cast("decimal(38,2)").alias("total"), F.lit(0).cast("long").alias("n"))

    def step(so_far: Column, s: Column) -> Column:
        total, n = (so_far["total"] + s["amount"]).cast("decimal(38,2)"), so_far["n"] + s["n"]
        return F.when(so_far["at"].isNotNull(), so_far).otherwise(
            F.struct(F.when(total >= target, s["at"]).alias("at"), total.alias("total"), n.alias("n")))
    return F.aggregate(steps, none, step)


def _check_as_of(as_of: str) -> None:
    if as_of not in (EVENT, DETECTION):
        raise ValueError(f"as_of is {EVENT!r} or {DETECTION!r}, not {as_of!r}")


def rule_r003(fact: DataFrame, p: RuleParams = RuleParams(), as_of: str = EVENT) -> DataFrame:
    """Pass-through: debits on the same account in hours (h, h + 72] after a
    large credit at hour h carry >= 80 % of it out.

    Instead of a range join (a credit fans out to every debit in 72 hours, and a
    hot account multiplies that), debits are summed per (account, hour) and a
    forward RANGE window over those hourly rows gives the outflow of every hour
    that holds a large credit. Credits then pick their outflow up with an
    equi-join on (account, hour).

    ``as_of='event'`` dates the alert at the credit, like the reference, with all of the 72 hours' outflow.
    ``as_of='detection'`` dates it at the hour in which the outflow reaches the share, the first moment at which the
    condition is known, with the outflow up to that hour: the window then keeps its hourly steps (72 at most), and
    each credit finds its crossing on their running total.
    """
    _check_as_of(as_of)
    credit = (F.col("direction") == "credit") & (F.col("amount_cad") >= p.r003_min_credit)
    debit = F.col("direction") == "debit"
    rel = fact.filter(credit | debit).select(
        "account_key", _hour_idx().alias("hr"),
        F.when(debit, F.col("amount_cad")).alias("d_amt"),
        F.when(debit, F.lit(1)).otherwise(F.lit(0)).alias("d_cnt"),
        F.when(credit, F.lit(1)).otherwise(F.lit(0)).alias("c_flag"))
    hourly = rel.groupBy("account_key", "hr").agg(
        F.sum("d_amt").alias("d_amt"), F.sum("d_cnt").alias("d_cnt"), F.max("c_flag").alias("c_flag"))
    w = Window.partitionBy("account_key").orderBy("hr").rangeBetween(1, p.r003_hours)
    cols = [F.coalesce(F.sum("d_amt").over(w), F.lit(0).cast(MONEY)).alias("outflow"), F.coalesce(F.sum("d_cnt").over(w), F.lit(0)).alias("n_out")]
    if as_of == DETECTION:
        step = F.when(F.col("d_amt").isNotNull(), F.struct(F.col("hr").cast("int").alias("at"), F.col("d_amt").alias("amount"), F.col("d_cnt").cast("long").alias("n")))
        cols.append(F.sort_array(F.collect_list(step).over(w)).alias("steps"))
    fwd = hourly.select("account_key", "hr", "c_flag", *cols).filter(F.col("c_flag") == 1).drop("c_flag")
    credits = fact.filter(credit).select("customer_key", "account_key", "date_key",
                                         _hour_idx().alias("hr"), F.col("amount_cad").alias("inflow"))
    per_credit = credits.join(fwd, ["account_key", "hr"], "inner") \
        .filter(F.col("outflow") >= F.col("inflow") * p.r003_ratio)
    if as_of == DETECTION:
        per_credit = (per_credit.withColumn("_hit", _first_reached(F.col("steps"), F.col("inflow") * p.r003_ratio))
                      .select("customer_key", F.floor(F.col("_hit.at") / 24).cast("int").alias("date_key"), "inflow",
                              F.col("_hit.total").alias("outflow"), F.col("_hit.n").alias("n_out")))
    g = per_credit.groupBy("customer_key", "date_key").agg(
        F.max("inflow").alias("a"), F.max("n_out").alias("c"), F.max("outflow").alias("o"))
    ratio = F.round(F.col("o").cast("double") * 100.0 / F.col("a").cast("double"), 0)
    return g.select(*_alert("R003", F.col("a"), F.col("c"),
                            F.concat(F.lit(detail_prefix("R003", p)), real_text(ratio.cast("decimal(38,0)")),
                                     F.lit(detail_suffix("R003", p)))))


#: Codes that one whole number has bits for.
CODE_BITS = 63


def _code_bits(code: Column, codes: list[str], name: str) -> list[Column]:
    """Aggregates ``name``0, ``name``1, ...: which of some sorted ``codes`` occur, a bit for each."""
    place = F.array_position(F.array(*[F.lit(c) for c in codes]), code) - 1 if codes else F.lit(None).cast("long")
    out = []
    for k in range(-(-len(codes) // CODE_BITS)):
        here = F.when((place >= k * CODE_BITS) & (place < (k + 1) * CODE_BITS), (place - k * CODE_BITS).cast("int"))
        out.append(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), here)).alias(f"{name}{k}"))
    return out


def _codes_text(codes: list[str], name: str) -> Column:
    """The codes of ``_code_bits`` in their order, joined by commas."""
    held = [F.when(F.col(f"{name}{i // CODE_BITS}").bitwiseAND(F.lit(1 << i % CODE_BITS)) != 0, F.lit(c)) for i, c in enumerate(codes)]
    return F.array_join(F.array(*held), ",") if held else F.lit("")


def customer_day_rules(fact: DataFrame, dim_country: DataFrame | None, p: RuleParams = RuleParams(),
                       which: tuple[str, ...] = ("R004", "R005")) -> DataFrame:
    """R004 (high-risk wires) and R005 (velocity spike) in one scan and one
    customer shuffle: both live on the (customer, date) grain.

    One aggregate per (customer, date) carries R005's credit volume over every
    active day (zero-credit days kept) and R004's sum, count and countries over
    its qualifying wires (conditional aggregates, combined map-side). The countries
    are bits of whole numbers, so that Spark hashes all of it; a set of strings
    would make it sort every customer-day.
    R005's two RANGE frames then run over ``partitionBy(customer_key)``; R004
    needs no window. With R004 alone only its wires are read and no window runs.
    """
    if not set(which) & {"R004", "R005"} or set(which) - {"R004", "R005"}:
        raise ValueError(f"customer_day_rules evaluates R004 and/or R005, got {which!r}")
    wire = (F.col("channel") == "wire") & (F.col("amount_cad") >= p.r004_min_amount)
    t = fact if "R005" in which else fact.filter(wire)
    zero = F.lit(0).cast(MONEY)
    aggs = []
    if "R005" in which:
        aggs.append(F.sum(F.when(F.col("direction") == "credit", F.col("amount_cad")).otherwise(zero))
                    .alias("credit_vol"))
    if "R004" in which:
        hr = dim_country.filter(F.col("is_high_risk") == 1).select(
            F.col("country_code").alias("counterparty_country"), F.lit(1).alias("_hr"))
        # dim_country is bounded by the number of jurisdictions: broadcast.
        codes = [r[0] for r in hr.filter("counterparty_country IS NOT NULL").select("counterparty_country").distinct()
                 .orderBy("counterparty_country").collect()]
        t = t.join(F.broadcast(hr), "counterparty_country", "left")
        r4 = wire & (F.col("_hr") == 1)
        aggs += [F.sum(F.when(r4, F.col("amount_cad"))).alias("r4_amt"),
                 F.count(F.when(r4, F.lit(1))).alias("r4_cnt"), *_code_bits(F.when(r4, F.col("counterparty_country")), codes, "r4_cc")]
    daily = t.groupBy("customer_key", "date_key").agg(*aggs)

    cands, hits = [], []
    if "R004" in which:
        hits.append(F.col("r4_cnt") > 0)
        cands.append(F.when(F.col("r4_cnt") > 0, F.struct(
            F.lit("R004").alias("rule_id"), F.col("r4_amt").cast("decimal(38,2)").alias("a"),
            F.col("r4_cnt").cast("long").alias("c"),
            F.concat(F.lit(detail_prefix("R004", p)), _codes_text(codes, "r4_cc")).alias("detail"))))
    if "R005" in which:
        base = Window.partitionBy("customer_key").orderBy("date_key")
        w30 = base.rangeBetween(-(p.r005_window_days - 1), Window.currentRow)
        wb = base.rangeBetween(-p.r005_baseline_from, -p.r005_baseline_to)
        vol = F.sum("credit_vol").over(w30)
        days = F.count(F.lit(1)).over(wb)
        baseline = F.sum("credit_vol").over(wb).cast("double") / days * float(p.r005_window_days)
        daily = daily.select("*", vol.alias("vol_30d"), days.alias("baseline_days"), baseline.alias("baseline_30d"))
        hit = ((F.col("baseline_days") >= p.r005_min_baseline_days) & (F.col("baseline_30d") > 0)
               & (F.col("vol_30d").cast("double") > F.lit(p.r005_multiplier) * F.col("baseline_30d"))
               & (F.col("vol_30d") > p.r005_min_volume))
        ratio = F.round(F.col("vol_30d").cast("double") / F.col("baseline_30d"), 1)
        hits.append(F.coalesce(hit, F.lit(False)))
        cands.append(F.when(hit, F.struct(
            F.lit("R005").alias("rule_id"), F.col("vol_30d").cast("decimal(38,2)").alias("a"),
            F.lit(None).cast("long").alias("c"),
            F.concat(F.lit(detail_prefix("R005", p)), ratio.cast("string"),
                     F.lit(detail_suffix("R005", p))).alias("detail"))))
    # Most customer-days fire nothing: drop them before the generator.
    x = (daily.filter(reduce(lambda a, b: a | b, hits))
         .select("customer_key", "date_key", F.explode(F.array(*cands)).alias("_x"))
         .filter(F.col("_x").isNotNull()))
    return x.select(
        F.concat(F.col("_x.rule_id"), F.lit("-"), F.col("customer_key").cast("string"), F.lit("-"),
                 F.col("date_key").cast("string")).alias("alert_id"),
        F.col("_x.rule_id").alias("rule_id"),
        F.col("customer_key").cast("long").alias("customer_key"),
        F.col("date_key").cast("int").alias("date_key"),
        F.col("_x.a").cast("double").alias("trigger_amount"),
        F.col("_x.c").alias("trigger_txn_count"),
        F.col("_x.detail").alias("detail"))


def rule_r004(fact: DataFrame, dim_country: DataFrame, p: RuleParams = RuleParams()) -> DataFrame:
    """High-risk wire: wires of at least the minimum to or from a high-risk
    jurisdiction, per (customer, date)."""
    return customer_day_rules(fact, dim_country, p, ("R004",))


def rule_r005(fact: DataFrame, p: RuleParams = RuleParams()) -> DataFrame:
    """Velocity spike over customer-days (zero-credit active days kept). The
    baseline averages the *active* days in the prior frame."""
    return customer_day_rules(fact, None, p, ("R005",))


def rule_r006(fact: DataFrame, p: RuleParams = RuleParams()) -> DataFrame:
    """Round-value clustering: wire/e-transfer, whole multiples of the unit,
    RANGE 167 preceding hours."""
    return customer_window_rules(fact, [spec_r006(p)])


def rule_r007(fact: DataFrame, p: RuleParams = RuleParams(), as_of: str = EVENT) -> DataFrame:
    """Dormant reactivation on account-days. Like the reference, the volume looks ``window_days - 1`` days
    *ahead* of the alert date (trap T-3) for ``as_of='event'``. ``as_of='detection'`` dates the alert at the day
    on which the volume since the reactivation reaches the minimum, with the volume up to that day."""
    _check_as_of(as_of)
    daily = fact.groupBy("account_key", "customer_key", "date_key").agg(F.sum("amount_cad").alias("day_vol"))
    lag_w = Window.partitionBy("account_key").orderBy("date_key", "customer_key")
    fwd_w = Window.partitionBy("account_key").orderBy("date_key") \
        .rangeBetween(Window.currentRow, p.r007_window_days - 1)
    cols = [(F.col("date_key") - F.lag("date_key").over(lag_w)).alias("gap_days"), F.sum("day_vol").over(fwd_w).alias("vol_7d")]
    if as_of == DETECTION:
        step = F.struct(F.col("date_key").cast("int").alias("at"), F.col("day_vol").alias("amount"), F.lit(0).cast("long").alias("n"))
        cols.append(F.sort_array(F.collect_list(step).over(fwd_w)).alias("steps"))
    r = daily.select("customer_key", "date_key", *cols)
    r = r.filter((F.col("gap_days") >= p.r007_gap_days) & (F.col("vol_7d") >= p.r007_min_volume))
    if as_of == DETECTION:
        hit = _first_reached(F.col("steps"), F.lit(p.r007_min_volume))
        day_total = F.aggregate(F.filter("steps", lambda s: s["at"] <= F.col("_at")), F.lit(0).cast("decimal(38,2)"),
                                lambda total, s: (total + s["amount"]).cast("decimal(38,2)"))
        r = r.withColumn("_at", hit["at"]).select("customer_key", F.col("_at").alias("date_key"), "gap_days", day_total.alias("vol_7d"))
    g = r.groupBy("customer_key", "date_key").agg(F.max("vol_7d").alias("a"), F.max("gap_days").alias("gap"))
    return g.select(*_alert("R007", F.col("a"), F.lit(None),
                            F.concat(F.lit(detail_prefix("R007", p)), F.col("gap").cast("string"),
                                     F.lit(detail_suffix("R007", p)))))


def rule_r008(fact: DataFrame, p: RuleParams = RuleParams()) -> DataFrame:
    """Sustained band cash: RANGE 29 preceding days."""
    return customer_window_rules(fact, [spec_r008(p)])


def all_alerts(parts: list[DataFrame]) -> DataFrame:
    """fact_alert (O-29): append every rule's alerts into one grain."""
    return reduce(lambda a, b: a.unionByName(b), [d.select(*ALERT_COLUMNS) for d in parts])


def alerts_by_rule(alerts: DataFrame, dim_rule: DataFrame) -> DataFrame:
    """O-30: alerts and distinct customers per rule, zero-alert rules kept."""
    per = alerts.groupBy("rule_id").agg(F.count(F.lit(1)).alias("alerts"),
                                        F.countDistinct("customer_key").alias("customers"))
    # dim_rule holds one row per rule (a handful): broadcast.
    return (F.broadcast(dim_rule.select("rule_id", "rule_name"))
            .join(per, "rule_id", "left")
            .select("rule_id", "rule_name",
                    F.coalesce(F.col("alerts"), F.lit(0)).cast("long").alias("alerts"),
                    F.coalesce(F.col("customers"), F.lit(0)).cast("long").alias("customers")))
