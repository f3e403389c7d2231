"""Call analytics: detail table, one field per call, recall flags and the call summary."""

from __future__ import annotations

from contextlib import AbstractContextManager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbre.functions import calls as C
from lumbre.operators.joins import HOT_ROWS, HOT_SHARE, left_join
from lumbre.operators.ranges import ranged
from lumbre.session import settings
from lumbre.sources.tables import save_scratch, scratch

CALL_COLUMNS = (
    "ivr_id",
    "phone_number",
    "ivr_result",
    "vdn_label",
    "start_date",
    "end_date",
    "total_duration",
    "customer_segment",
    "ivr_language",
    "steps_module",
    "module_aggregation",
)
MODULE_COLUMNS = ("module_sequece", "module_name", "module_duration", "module_result")
STEP_COLUMNS = (
    "step_sequence",
    "step_name",
    "step_result",
    "step_description_error",
    "document_type",
    "document_identification",
    "customer_phone",
    "billing_account_id",
)


#: Call columns that get a day id.
DAYS = ("start_date", "end_date")


def prefix_calls(calls: DataFrame, *more: str) -> DataFrame:
    """Call columns under their ``calls_`` names, with the two day ids (made here, unless they come as ``_..._id``)."""
    out: list[Column] = []
    for name in CALL_COLUMNS:
        out.append(F.col(name).alias(f"calls_{name}"))
        if name in DAYS:
            day = F.col(f"_{name}_id") if f"_{name}_id" in calls.columns else C.date_id(F.col(name))
            out.append(day.alias(f"calls_{name}_id"))
    return calls.select(*out, *more)


def detail(
    calls: DataFrame,
    modules: DataFrame,
    steps: DataFrame,
    salt: bool = False,
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
    steps_first: bool = False,
) -> DataFrame:
    """One row per step; calls without modules and modules without steps stay.

    Steps are matched on the id of the call, not of the module: it is the same id where a module
    exists, and calls without one keep a hashable key instead of all meeting in the NULL partition.

    With ``steps_first`` modules get their steps before calls get both, and the rows come dealt by the id of the call.
    This is the cheaper way to all columns; the other way readers of a few columns are spared the join of the steps.
    """
    keys = ["ivr_id", "module_sequece"]
    calls = calls.select(*CALL_COLUMNS)
    modules, steps = modules.select("ivr_id", *MODULE_COLUMNS), steps.select(*keys, *STEP_COLUMNS)
    if steps_first:
        with_steps = left_join(modules, steps, keys, salt, share, min_rows).hint("merge")
        calls = calls.withColumns({f"_{name}_id": C.date_id(F.col(name)) for name in DAYS})  # once per call, not per step
        return prefix_calls(left_join(calls, with_steps, ["ivr_id"], salt, share, min_rows), *MODULE_COLUMNS, *STEP_COLUMNS)
    with_modules = left_join(calls, modules, ["ivr_id"], salt, share, min_rows)
    with_steps = left_join(with_modules, steps, keys, salt, share, min_rows)
    return prefix_calls(with_steps, *MODULE_COLUMNS, *STEP_COLUMNS)


def dealt_by_call(spark: SparkSession) -> AbstractContextManager[None]:
    """Let joins by call and module take modules and steps as they are dealt, by the id of the call alone."""
    return settings(spark, spark__sql__requireAllClusterKeysForCoPartition="false")


# ---------------------------------------------------------------- one field per call


def vdn_aggregation(calls: DataFrame) -> DataFrame:
    return calls.select("ivr_id", C.vdn_aggregation(F.col("vdn_label")).alias("vdn_aggregation"))


def document_best_row(detail: DataFrame) -> DataFrame:
    """The preferred row of every call: a known document first, then the latest module and step.

    ``row_number = 1`` is planned with a group limit before the shuffle, so each map task sends one
    row per call however many steps a call has. The document columns at the end only settle ties.
    """
    best = Window.partitionBy("ivr_id").orderBy(
        F.desc_nulls_last("has_document_lg"),
        F.desc_nulls_last("module_sequece"),
        F.desc_nulls_last("step_sequence"),
        F.desc_nulls_last("document_identification"),
        F.desc_nulls_last("document_type"),
    )
    return (
        detail.select(
            F.col("calls_ivr_id").cast("string").alias("ivr_id"),
            "document_identification",
            "document_type",
            "module_sequece",
            "step_sequence",
            C.flag(C.document_known(F.col("document_identification"))).alias("has_document_lg"),
        )
        .withColumn("rn", F.row_number().over(best))
        .where("rn = 1")
        .select("ivr_id", "document_identification", "document_type")
    )


def known_documents(detail: DataFrame) -> DataFrame:
    """Latest known document per call; calls without one are absent."""
    latest = Window.partitionBy("calls_ivr_id").orderBy(
        F.desc_nulls_last("module_sequece"),
        F.desc_nulls_last("step_sequence"),
        F.desc_nulls_last("document_identification"),
        F.desc_nulls_last("document_type"),
    )
    return (
        detail.where(C.document_known(F.col("document_identification")))
        .select("calls_ivr_id", "document_identification", "document_type", "module_sequece", "step_sequence")
        .withColumn("rn", F.row_number().over(latest))
        .where("rn = 1")
        .drop("rn", "module_sequece", "step_sequence")
    )


def with_document(detail: DataFrame) -> DataFrame:
    """Every row with the latest known document of its call, NULL where there is none.

    The maximum per id is combined before its shuffle and joined back, so an id with many rows may be split.
    Rows without an id match nothing and are spread by their start.
    """
    known = C.document_known(F.col("document_identification")) & F.col("calls_ivr_id").isNotNull()
    latest = detail.where(known).groupBy("calls_ivr_id").agg(_latest_document().alias("_doc"))
    names = ("document_identification", "document_type")
    found = _join_by_id(detail.withColumn("_spread", _spread()), latest.withColumn("_spread", F.lit(None).cast("bigint")))
    return found.withColumns({n: F.col("_doc")[n] for n in names}).drop("_doc")


def _join_by_id(rows: DataFrame, by_id: DataFrame) -> DataFrame:
    """Left join of rows to one row per ``calls_ivr_id`` and ``_spread``; ``_spread`` is dropped.

    The keys are compared null-safe, and so are other expressions than those ``by_id`` is grouped by: the grouped rows
    are shuffled once more, and adaptive execution may split the rows of a hot id.
    """
    keys = ("calls_ivr_id", "_spread")
    right = by_id.withColumnsRenamed({k: f"_of{k}" for k in keys})
    same = F.col("calls_ivr_id").eqNullSafe(F.col("_ofcalls_ivr_id")) & F.col("_spread").eqNullSafe(F.col("_of_spread"))
    return rows.join(right, same, "left").drop("_spread", *(f"_of{k}" for k in keys))


def _join_dealt_by_id(rows: DataFrame, by_id: DataFrame) -> DataFrame:
    """``_join_by_id`` for spreads on both sides, with its rows dealt as the buckets by id are.

    Both are compared null-safe. Rows are dealt by the id, those without one by their spread: another expression than
    those ``by_id`` is grouped by, so the grouped rows are shuffled once more, and adaptive execution may split the
    rows of a hot id. So all rows of a bucket by id come to one task, but those without an id.
    """
    keys = ("calls_ivr_id", "_spread")
    right = by_id.withColumnsRenamed({k: f"_of{k}" for k in keys}).hint("merge")
    kind = rows.schema["calls_ivr_id"].dataType

    def dealt(prefix: str) -> Column:
        return F.coalesce(F.col(f"{prefix}calls_ivr_id"), F.pmod(f"{prefix}_spread", F.lit(_INT_MAX)).cast(kind))

    same = [F.when(F.col(k).isNull(), F.col(f"_of{k}").isNull()).otherwise(F.col(k) == F.col(f"_of{k}")) for k in keys]
    return rows.join(right, (dealt("") == dealt("_of")) & same[0] & same[1], "left").drop("_spread", *(f"_of{k}" for k in keys))


#: Spreads are cut to this, so that they fit the type of any id.
_INT_MAX = 2**31 - 1


def document_known_row(detail: DataFrame) -> DataFrame:
    """Latest known document of every call, DESCONOCIDO where there is none.

    A conditional maximum of (module, step, document) gives the same row as filter, rank, left join
    back, in one aggregation that is combined before its shuffle.
    """
    found = detail.groupBy("calls_ivr_id").agg(_latest_document().alias("doc"))
    return found.select("calls_ivr_id", *_document_columns(F.col("doc")))


def _spread() -> Column:
    """A second key for rows without an id, so that they do not all meet in one task."""
    return F.when(F.col("calls_ivr_id").isNull(), F.xxhash64("calls_phone_number", "calls_start_date"))


def _latest_document() -> Column:
    row = F.struct("module_sequece", "step_sequence", "document_identification", "document_type")
    return F.max(F.when(C.document_known(F.col("document_identification")), row))


def _document_columns(doc: Column) -> list[Column]:
    return [
        F.coalesce(doc[name], F.lit(C.NOT_FOUND)).alias(name) for name in ("document_type", "document_identification")
    ]


def customer_phone(detail: DataFrame) -> DataFrame:
    return detail.groupBy("calls_ivr_id").agg(C.best_known_text(F.col("customer_phone")).alias("customer_phone"))


def billing_account_id(detail: DataFrame) -> DataFrame:
    value = C.best_known_text(F.col("billing_account_id"))
    return detail.groupBy("calls_ivr_id").agg(value.alias("billing_account_id"))


def _flags() -> dict[str, Column]:
    by_phone = C.step_succeeded(F.col("step_name"), F.col("step_result"), C.STEP_BY_PHONE)
    by_dni = C.step_succeeded(F.col("step_name"), F.col("step_result"), C.STEP_BY_DNI)
    return {
        "masiva_lg": C.any_flag(C.mass_outage(F.col("module_name"))),
        "info_by_phone_lg": C.any_flag(by_phone),
        "info_by_dni_lg": C.any_flag(by_dni),
    }


def call_flag(detail: DataFrame, name: str) -> DataFrame:
    """``masiva_lg``, ``info_by_phone_lg`` or ``info_by_dni_lg`` per call."""
    return detail.groupBy("calls_ivr_id").agg(_flags()[name].alias(name))


# ---------------------------------------------------------------- recall within 24 hours

#: Elapsed whole seconds 1..86400 mean an elapsed time in [1 s, 86401 s); in microseconds:
_SECOND = 1_000_000
_NEAR = _SECOND
_FAR = (C.DAY_SECONDS + 1) * _SECOND - 1


def _second(u: Column) -> Column:
    return ((u - F.pmod(u, F.lit(_SECOND))) / _SECOND).cast("bigint")


def _call_starts(detail: DataFrame) -> DataFrame:
    """(ivr_id, phone, u) of every row: the phone is NULL where it is not known, ``u`` is the start
    in microseconds."""
    return detail.select(
        F.col("calls_ivr_id").alias("ivr_id"),
        F.nullif("calls_phone_number", F.lit(C.UNKNOWN)).alias("phone"),
        F.unix_micros("calls_start_date").alias("u"),
    )


def attach_recall(calls: DataFrame, starts: DataFrame) -> DataFrame:
    """Add both recall flags to call-level rows that have ``ivr_id``, ``phone`` and ``u``.

    ``starts`` holds these three columns for all calls (repeats do not matter). A call is repeated
    when another call of the same phone began in the 24 hours before it, and causes a recall when
    one began after it. Rows of its own id never count, however many starts the id has.

    No pairs are built, and nothing is gathered by phone or by id. Starts are summed up per phone and second, keeping
    the two first and the two last ones of different ids. At least one whole second apart, the nearest neighbour of
    another id decides whether any is in reach; it is found by a scan over those summaries in ranges of bounded size
    (``_with_neighbours``). The join back is on phone and second, which the scan is not dealt by, so adaptive execution
    can split the calls of a hot pair.
    """
    with scratch(calls.sparkSession) as scope:
        near = _with_neighbours(_per_second(starts))
        joined = calls.withColumn("sec", _second(F.col("u"))).join(near, ["phone", "sec"], "left")
        flags = _flag_columns(*(_reached(name, sign) for name, sign in WAYS.items()))
        return scope.keep(joined.withColumns(flags).drop("sec", *WAYS))


def _flag_columns(before: Column, after: Column) -> dict[str, Column]:
    usable = F.col("ivr_id").isNotNull()
    return {
        "repeated_phone_24H": C.flag(usable & before),
        "cause_recall_phone_24H": C.flag(usable & after),
    }


def _per_second(starts: DataFrame) -> DataFrame:
    """(phone, sec, lo, lo2, hi, hi2): the first and the last start of a second with their ids, and the first and the
    last one of any other id.

    Two rows per second are kept by rank, which Spark limits before the shuffle as well, so a second with very many
    ids sends two rows per task.
    """
    usable = starts.where("ivr_id is not null and phone is not null and u is not null")
    per_id = usable.groupBy("phone", _second(F.col("u")).alias("sec"), "ivr_id").agg(F.min("u").alias("lo"), F.max("u").alias("hi"))
    second = Window.partitionBy("phone", "sec")
    ends = []
    for name, order in (("lo", F.col("lo").asc()), ("hi", F.col("hi").desc())):
        ranked = per_id.withColumn("n", F.row_number().over(second.orderBy(order, "ivr_id"))).where("n <= 2")
        end = F.struct(F.col(name).alias("u"), "ivr_id")
        ends.append(ranked.select("phone", "sec", F.lit(name).alias("end"), "n", end.alias("at")))

    def kept(end: str, n: int) -> Column:
        return F.max(F.when((F.col("end") == end) & (F.col("n") == n), F.col("at")))

    return ends[0].unionByName(ends[1]).groupBy("phone", "sec").agg(
        kept("lo", 1).alias("lo"), kept("lo", 2)["u"].alias("lo2"), kept("hi", 1).alias("hi"), kept("hi", 2)["u"].alias("hi2")
    )


#: The two ways to look, and the sign of time: looking ahead is looking back in negated time.
WAYS = {"before": 1, "after": -1}


def _facing(sign: int) -> dict[str, Column]:
    """A second's summary in signed time: ``first`` and ``last`` start with their ids, those of any other id."""

    def signed(end: str) -> tuple[Column, Column]:
        return F.struct((sign * F.col(f"{end}.u")).alias("u"), F.col(f"{end}.ivr_id").alias("ivr_id")), sign * F.col(f"{end}2")

    low, high = ("lo", "hi") if sign > 0 else ("hi", "lo")
    (first, first_other), (last, last_other) = signed(low), signed(high)
    return {"t": sign * F.col("sec"), "first": first, "first_other": first_other, "last": last, "last_other": last_other}


def _state(top: Column, other: Column) -> Column:
    """The last start so far with its id, and the last one of any other id."""
    return F.struct(top.alias("top"), other.alias("other"))


def _continued(came: Column, state: Column) -> Column:
    """A state of later rows, after the state ``came`` of those before them."""
    earlier = F.when(came["top"]["ivr_id"] != state["top"]["ivr_id"], came["top"]["u"]).otherwise(came["other"])
    return F.when(state.isNull(), came).when(came.isNull(), state).otherwise(
        _state(state["top"], F.coalesce(state["other"], earlier))
    )


def _turns(top: Column, other: Column, before: Column) -> Column:
    """Where the last start of another id changes: to one in this row, or to the row before if that has another id."""
    return F.coalesce(other, F.when(before["ivr_id"] != top["ivr_id"], before["u"]))


def _looked_back(ranges: DataFrame, name: str, sign: int) -> DataFrame:
    """What each second sees behind it within its range: states one and two rows back, and the row beside it."""
    own = _facing(sign)
    walk = Window.partitionBy("part", "phone").orderBy("_t")
    upto = walk.rowsBetween(Window.unboundedPreceding, 0)
    rows = ranges.withColumns({f"_{k}": v for k, v in own.items()})
    rows = rows.withColumn("_turn", _turns(F.col("_last"), F.col("_last_other"), F.lag("_last").over(walk)))
    rows = rows.withColumn("_state", _state(F.col("_last"), F.last("_turn", ignorenulls=True).over(upto)))
    beside = F.struct(F.col("_t").alias("t"), F.col("_first").alias("first"), F.col("_first_other").alias("other"))
    here = F.struct(
        F.lag("_state").over(walk).alias("one"),
        F.lag("_state", 2).over(walk).alias("two"),
        F.lag(beside).over(walk).alias("beside"),
        F.when(F.lead("_t").over(walk).isNull(), F.struct(F.col("_state").alias("state"), beside.alias("beside"))).alias("end"),
    )
    return rows.withColumn(name, here).drop("_turn", "_state", *(f"_{k}" for k in own))


def _carries(local: DataFrame) -> DataFrame:
    """What comes into each range of a phone that goes on from another one, either way: one row per such range."""
    ends = local.where(" or ".join(f"{name}.end is not null" for name in WAYS)).groupBy("phone", "part").agg(
        *[F.max(F.when(F.col(f"{name}.end").isNotNull(), F.struct(f"{name}.end", f"{name}.one"))).alias(name) for name in WAYS]
    )
    for name, sign in WAYS.items():
        over = Window.partitionBy("phone").orderBy(sign * F.col("part"))
        end = F.col(name)["end"]
        top, other = end["state"]["top"], end["state"]["other"]
        ends = ends.withColumn("_turn", _turns(top, other, F.lag(top).over(over)))
        whole = F.last("_turn", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, 0))
        ends = ends.withColumn("_whole", _state(top, whole))
        ends = ends.withColumn("_came", F.lag("_whole").over(over))
        ends = ends.withColumn("_but_last", _continued(F.col("_came"), F.col(name)["one"]))
        carry = F.struct(F.col("_came").alias("came"), F.lag("_but_last").over(over).alias("but_last"), F.lag(end["beside"]).over(over).alias("beside"))
        ends = ends.withColumn(f"{name}_carry", carry)
    return ends.where(" or ".join(f"{name}_carry.came is not null" for name in WAYS)).select("part", "phone", *[f"{name}_carry" for name in WAYS])


def _with_neighbours(seconds: DataFrame) -> DataFrame:
    """(phone, sec, before, after): for each second and way to look the second next to it, if there is one, and the
    nearest starts of two different ids at least two seconds away.

    A scan in segments: seconds are dealt into ranges of about equal size by phone and time, each range is scanned by
    itself, the states at the ends of ranges are scanned once more (as many rows as a phone has ranges), and what
    comes into a range is put before the states inside. So one phone may hold any share of the calls.
    """
    # Saved, as Spark runs what it deals into ranges twice: once more for the sample.
    local = ranged(save_scratch(seconds, "recall-seconds"), ["phone", "sec"])
    for name, sign in WAYS.items():
        local = _looked_back(local, name, sign)
    local = save_scratch(local.select("phone", "sec", "part", *WAYS), "recall-local")
    out = local.join(_carries(local), ["part", "phone"], "left")
    for name, sign in WAYS.items():
        here, carry = F.col(name), F.col(f"{name}_carry")
        beside = F.coalesce(here["beside"], carry["beside"])
        one = _continued(carry["came"], here["one"])
        two = F.when(here["one"].isNull(), carry["but_last"]).otherwise(_continued(carry["came"], here["two"]))
        adjacent = beside["t"] == sign * F.col("sec") - 1
        out = out.withColumn(name, F.struct(F.when(adjacent, beside).alias("beside"), F.when(adjacent, two).otherwise(one).alias("far")))
    return out.select("phone", "sec", *WAYS)


def _reached(name: str, sign: int) -> Column:
    """Whether a start of another id lies within reach on this side of a call."""
    u, seen = sign * F.col("u"), F.col(name)

    def of_another(top: Column, other: Column) -> Column:
        return F.when(top["ivr_id"] != F.col("ivr_id"), top["u"]).otherwise(other)

    beside = of_another(seen["beside"]["first"], seen["beside"]["other"]) <= u - _NEAR
    far = of_another(seen["far"]["top"], seen["far"]["other"]) >= u - _FAR
    return F.coalesce(beside, F.lit(False)) | F.coalesce(far, F.lit(False))


def recall_24h(detail: DataFrame) -> DataFrame:
    """Both recall flags per call id, 0 for calls that match nothing. Of the detail only the call columns are used;
    where it is a plan of joins, give the call table itself (``prefix_calls``)."""
    with scratch(detail.sparkSession) as scope:
        starts = save_scratch(_call_starts(detail).distinct(), "starts")
        flagged = scope.keep(attach_recall(starts, starts))
    return flagged.groupBy(F.col("ivr_id").alias("calls_ivr_id")).agg(
        F.max("repeated_phone_24H").alias("repeated_phone_24H"),
        F.max("cause_recall_phone_24H").alias("cause_recall_phone_24H"),
    )


# ---------------------------------------------------------------- summary

SUMMARY_KEYS = (
    "calls_ivr_id",
    "calls_phone_number",
    "calls_ivr_result",
    "vdn_aggregation",
    "calls_start_date",
    "calls_end_date",
    "calls_total_duration",
    "calls_customer_segment",
    "calls_ivr_language",
    "calls_steps_module",
    "calls_module_aggregation",
)


def summary(detail: DataFrame, calls: DataFrame | None = None) -> DataFrame:
    """One row per call with every derived field.

    All step fields come from one aggregation by the id of the call, combined before its shuffle; the modules and
    steps of an id belong to all rows of that id. They are joined to the distinct call rows, of which an id may have
    any number. Recall neighbours are worked out on three slim columns and joined at call level, never at step level.
    Call rows and neighbours are taken from ``calls`` (the call table the detail was made of) if given, so that the
    joins of a detail that is still a plan run once.
    """
    source = detail if calls is None else prefix_calls(calls)
    by_id = (
        detail.withColumn("_spread", _spread())
        .groupBy("calls_ivr_id", "_spread")
        .agg(
            _latest_document().alias("doc"),
            C.best_known_text(F.col("customer_phone")).alias("customer_phone"),
            C.best_known_text(F.col("billing_account_id")).alias("billing_account_id"),
            *[expr.alias(name) for name, expr in _flags().items()],
        )
    )
    starts = _call_starts(source).distinct()
    call = F.struct(*SUMMARY_KEYS[1:]).alias("_call")
    rows = source.withColumn("vdn_aggregation", C.vdn_aggregation(F.col("calls_vdn_label")))
    rows = rows.select("calls_ivr_id", _spread().alias("_spread"), call).distinct()
    rows = rows.withColumns(
        {
            "ivr_id": F.col("calls_ivr_id"),
            "phone": F.nullif("_call.calls_phone_number", F.lit(C.UNKNOWN)),
            "u": F.unix_micros("_call.calls_start_date"),
        }
    )
    # by the id last: its rows are then dealt as the buckets of a table by id are
    flagged = attach_recall(rows, starts).drop("ivr_id", "phone", "u")
    return _join_dealt_by_id(flagged, by_id).select("*", "_call.*").select(
        *SUMMARY_KEYS,
        *_document_columns(F.col("doc")),
        "customer_phone",
        "billing_account_id",
        "masiva_lg",
        "info_by_phone_lg",
        "info_by_dni_lg",
        "repeated_phone_24H",
        "cause_recall_phone_24H",
    )
