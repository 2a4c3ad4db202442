"""Store-operations measures over alerts, alarm events and evaluations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: An Imei and day with more than this share of all events is dealt to ``SALTS`` tasks: at most 1000 of them.
HEAVY, SALTS = 1000, 64


def alarm_events_of_alerts(alerts: DataFrame, events: DataFrame, after_hours: int = 12, before_hours: int = 29, salts: int = SALTS) -> DataFrame:
    """Pairs of an alert and an alarm event of the same Imei in the open interval (day + 12 h, day + 29 h), on another date (J-4).

    An event falls into the interval of at most two days, so it is given those days and the join is on Imei and day:
    a hash join that deals out a busy Imei by day, in place of a range join. Imeis that are busy on one day are found by a
    count; their events are dealt out by a salt, and their alerts of that day go to each of the salts. All other rows have
    salt 0. ``salts=1`` saves the count.
    """
    day = F.to_date("FechaAbierto")
    a = alerts.withColumn("day_", day)
    shifted = lambda h: F.to_date(F.col("Fecha").cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(h)))
    e = events.withColumn("day_", F.explode(F.sequence(shifted(before_hours), shifted(after_hours))))
    start = F.col("day_").cast("timestamp_ntz")
    inside = (F.col("Fecha").cast("timestamp_ntz") > start + F.make_dt_interval(hours=F.lit(after_hours))) & (F.col("Fecha").cast("timestamp_ntz") < start + F.make_dt_interval(hours=F.lit(before_hours)))
    e = e.where(inside & (F.to_date("Fecha") != F.col("day_")))
    keys = ["Imei", "day_"]
    if salts > 1:
        counts = e.groupBy(*keys).count()
        total = counts.agg(F.sum("count")).scalar()
        heavy = counts.where(F.col("count") * HEAVY > total).select(*keys, F.lit(True).alias("heavy_"))
        busy = F.coalesce(F.col("heavy_"), F.lit(False))
        e = e.join(F.broadcast(heavy), keys, "left").withColumn("salt_", F.when(busy, F.pmod(F.xxhash64("Fecha", F.monotonically_increasing_id()), F.lit(salts)).cast("int")).otherwise(0)).drop("heavy_")
        each = F.when(busy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        a = a.join(F.broadcast(heavy), keys, "left").withColumn("salt_", F.explode(each)).drop("heavy_")
        keys = [*keys, "salt_"]
    return a.join(e, keys).drop("day_", "salt_")


def stores_not_armed(alerts: DataFrame, communicators: DataFrame, events: DataFrame, codes: DataFrame, alert_type: int = 23, closed_status: int = 6, event_codes: tuple[int, ...] = (401, 407), zone: int = 3) -> DataFrame:
    """Alerts of stores that were not armed, with the alarm event of the night after (M-1): distinct rows."""
    open_ = alerts.where((F.col("Fk_TipoAlerta") == alert_type) & (F.col("Fk_EstatusAlerta") != closed_status))
    open_ = open_.join(communicators.select(F.col("Fk_Tienda"), "Imei"), "Fk_Tienda")
    rung = events.where(F.col("Fk_Code").isin(*event_codes) & (F.col("Fk_Zona") == zone))
    named = codes.select(F.col("Codigo").alias("Fk_Code"), F.col("Zona").alias("Fk_Zona"), "Evento")
    pairs = alarm_events_of_alerts(open_, rung).join(named, ["Fk_Code", "Fk_Zona"], "left")
    return pairs.select(F.col("Id").alias("IdAlerta"), F.col("Fk_Tienda").alias("IdTienda"), "Imei", "Anotacion", "FechaAbierto", F.col("Fecha").alias("FechaAlarma"), "Evento", "Fk_Origen").distinct()


def count_measures(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """One row: for each name, the number of rows that its condition holds for, all in one pass (A-13)."""
    return df.agg(*[F.count_if(c).alias(n) for n, c in measures.items()])


def not_armed_total(detail: DataFrame, alerts: DataFrame, solutions: tuple[int, ...] = (87, 43, 89, 42)) -> DataFrame:
    """n_not_armed, n_by_solution and their sum (M-2 to M-4). A measure without rows is blank, and so null; a blank adds nothing, and two are blank."""
    blank = lambda n: F.when(F.col(n) > 0, F.col(n))
    one = detail.agg(F.count("*").alias("n"))
    two = alerts.agg(F.count_if(F.col("Fk_Solucion").isin(*solutions)).alias("m"))
    both = one.select("n", F.lit(0).cast("long").alias("m")).unionByName(two.select(F.lit(0).cast("long").alias("n"), "m")).agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    return both.select(blank("n").alias("n_not_armed"), blank("m").alias("n_by_solution"), F.nullif(F.col("n") + F.col("m"), F.lit(0)).alias("n_total"))


def alerts_by_description(alerts: DataFrame, types: DataFrame, descriptions: dict[str, str]) -> DataFrame:
    """Counts of alerts whose type has a description: measure name -> description (J-9, M-5 to M-7). Types are few; Spark broadcasts them by size."""
    named = alerts.join(types.select(F.col("Id").alias("type_"), "Descripcion"), alerts["Fk_TipoAlerta"] == F.col("type_"), "left")
    return count_measures(named, {n: F.col("Descripcion") == d for n, d in descriptions.items()})


def by_day(evaluations: DataFrame) -> DataFrame:
    """A row for each day of an evaluation, from its start to its end, as ``Fecha``; none if it ends before it starts (J-5)."""
    days = F.sequence(F.to_date("FechaInicio"), F.to_date("FechaFin"))
    return evaluations.where(F.to_date("FechaInicio") <= F.to_date("FechaFin")).withColumn("Fecha", F.explode(days))


def daily_opportunity(evaluations: DataFrame, modules: DataFrame, module: str, source: str = "module", since: str | None = None, until: str | None = None) -> DataFrame:
    """Mean daily opportunity of each date, store and module (J-5, J-6, A-12, M-8 to M-10).

    An evaluation counts for the days from its start to its end with its opportunity, or its module's
    (``source="evaluation"`` or ``"module"``), over seven. Values that are no numbers are left out of the mean; a day that
    has no others has a null one.

    A sweep line: an evaluation is two changes, of the sum and the numbers of values and evaluations, on its first day and
    on the day after its last. Changes are added up by day before the shuffle, however long evaluations are; running sums
    by store then hold from each change to the next one, and only those results are laid out by day.
    """
    if source not in ("evaluation", "module"):
        raise ValueError("source must be evaluation or module")
    m = modules.where(F.col("Fk_ModuloEvaluable") == module).select(F.col("Fk_EvaluacionGeneral").alias("Id"), "Fk_ModuloEvaluable", F.col("Oportunidad").alias("of_module"))
    value = F.col("of_module" if source == "module" else "Oportunidad")
    each = evaluations.join(m, "Id").withColumn("x", (value.try_cast("decimal(18,6)") / 7).try_cast("decimal(9,4)"))
    first, last = F.to_date("FechaInicio"), F.to_date("FechaFin")
    first = first if since is None else F.greatest(first, F.lit(since).cast("date"))
    last = last if until is None else F.least(last, F.lit(until).cast("date"))
    each = each.withColumns({"first_": first, "last_": last}).where("first_ <= last_")
    change = lambda at, sign: F.struct(at.alias("at"), (F.lit(sign) * F.coalesce("x", F.lit(0).cast("decimal(9,4)"))).cast("decimal(38,4)").alias("x"), (F.lit(sign) * F.col("x").isNotNull().cast("long")).alias("n"), F.lit(sign).cast("long").alias("k"))
    both = F.array(change(F.col("first_"), 1), change(F.date_add("last_", 1), -1))
    store = ["Fk_Tienda", "Fk_ModuloEvaluable"]
    changes = each.select(*store, F.explode(both).alias("c")).groupBy(*store, "c.at").agg(*[F.sum(f"c.{c}").alias(c) for c in ("x", "n", "k")])
    order = Window.partitionBy(*store).orderBy("at")
    now = lambda c: F.sum(c).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias(c)
    held = changes.select(*store, "at", now("x"), now("n"), now("k"), F.lead("at").over(order).alias("next")).where("k > 0")
    days = held.withColumn("Fecha", F.explode(F.sequence("at", F.date_sub("next", 1))))
    mean = F.when(F.col("n") > 0, F.col("x").cast("double") / F.col("n"))
    return days.select("Fecha", *store, mean.alias("Oportunidad"))
