"""Profiles of raw attributes, and drift of the catalogue against them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.operators.otlp import Entry
from loamline.sources.shared import written

col = F.col
#: Cardinality is reported up to this number.
CAP = 500


def catalogue_frame(df: DataFrame, catalogue: Iterable[Entry]) -> DataFrame:
    """The catalogue, a few hundred rows at most, as a frame of the same session."""
    rows = [(e.signal, e.name, e.path, e.status, e.basis, e.partner) for e in catalogue]
    return df.sparkSession.createDataFrame(rows, "signal string, name string, path string, status string, basis string, partner string")


def path_fill(paths: DataFrame) -> DataFrame:
    """Payloads that carry each path, once per payload."""
    return paths.groupBy("signal", "path").agg(F.count_distinct("payload_id").alias("payloads"))


def top_of(values: DataFrame, keys: list[str], k: int, *, parts: int = 64) -> DataFrame:
    """Of (keys, value, n) the k most frequent values of each key with their ``rank``; ties by value.

    A key may have as many values as there are rows, so its head is found in ``parts`` first: no task sees all values of a key.
    """
    order = [col("n").desc(), col("value")]
    heads = values.withColumn("_part", F.pmod(F.xxhash64("value"), F.lit(parts)))
    heads = heads.withColumn("rank", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))).where(col("rank") <= k)
    return heads.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(col("rank") <= k).drop("_part")


def value_samples(attrs: DataFrame, *, top: int = 5) -> DataFrame:
    """The most frequent values of each path with the path's cardinality; ties by value."""
    keys = ["signal", "path"]
    n = written(attrs.groupBy(*keys, "value").agg(F.count("*").alias("n")), "values")
    return top_of(n, keys, top).join(n.groupBy(*keys).agg(F.count("*").alias("cardinality")), keys)


def reach_of(rows: DataFrame, who: str, name: str) -> DataFrame:
    """(signal, name, path, ``name``): how many values of ``who`` have records of a name that carry a path; none for NULL.

    A record is shuffled once with all its paths, and lists of paths that a group has already are dropped before.
    """
    some = rows.where(col(who).isNotNull()).select("signal", "name", who, F.map_keys("attrs").alias("paths"))
    each = some.groupBy("signal", "name", who).agg(F.collect_set("paths").alias("lists"))
    return each.select("signal", "name", F.explode(F.array_distinct(F.flatten("lists"))).alias("path")).groupBy("signal", "name", "path").agg(F.count("*").alias(name))


def record_profile(recs: DataFrame, *, session: str = "session.id", seat: str = "user.email") -> DataFrame:
    """Per signal, name and path: records, sessions, seats, capped cardinality, top three, share of the name's records.

    Records are decoded once, into a table that the counts read.
    """
    either = lambda key: F.coalesce(F.element_at("resource", key), F.element_at("attrs", key))
    rows = written(recs.select("signal", "name", either(session).alias("session"), either(seat).alias("seat"), "attrs"), "records")
    population = rows.groupBy("signal", "name").agg(F.count("*").alias("population"))
    flat = rows.select("signal", "name", F.explode("attrs").alias("path", "value"))
    keys = ["signal", "name", "path"]
    # values first, so that a path with few values and many records is counted in parts
    values = written(flat.groupBy(*keys, "value").agg(F.count("*").alias("n")), "values")
    basic = values.groupBy(*keys).agg(F.sum("n").alias("records"))
    for who in ("session", "seat"):
        basic = basic.join(reach_of(rows, who, f"{who}s"), keys, "left").withColumn(f"{who}s", F.coalesce(f"{who}s", F.lit(0)))
    sizes = values.groupBy(*keys).agg(F.least(F.count("*"), F.lit(CAP)).alias("cardinality"))
    top = top_of(values, keys, 3).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rank", "value"))).alias("t"))
    out = basic.join(sizes, keys).join(top, keys).join(population, ["signal", "name"])
    return out.select(*keys, "records", "sessions", "seats", "cardinality", F.concat_ws(",", F.transform("t", lambda x: x["value"])).alias("top3"), (col("records") / col("population")).alias("share"))


def path_shares(recs: DataFrame) -> DataFrame:
    """Per signal, name and path: records and their share of the name's records, as in ``record_profile``. No value is looked at, so none is shuffled.

    A name's records count as those of no path, so that records are decoded once.
    """
    paths = F.explode(F.concat(F.array(F.lit(None).cast("string")), F.map_keys("attrs"))).alias("path")
    n = recs.select("signal", "name", paths).groupBy("signal", "name", "path").agg(F.count("*").alias("records"))  # as many rows as the catalogue might list
    n = n.withColumn("population", F.max(F.when(col("path").isNull(), col("records"))).over(Window.partitionBy("signal", "name")))
    return n.where("path IS NOT NULL").select("signal", "name", "path", "records", (col("records") / col("population")).alias("share"))


def few_valued(flat: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Keys whose values may be ``most`` or fewer, without shuffling a value: each value sets one of 64 bits of its key, and a key with more than
    ``most`` bits has more values than that. Keys that are left may have more too, by about as many as share a bit.
    """
    bit = F.expr("shiftleft(1L, CAST(pmod(xxhash64(value), 64) AS INT))")
    return flat.groupBy(*keys).agg(F.bit_or(bit).alias("bits")).where(F.bit_count("bits") <= most).select(*keys)


def seat_reach(recs: DataFrame, *, most_values: int = 25, seat: str = "user.email") -> DataFrame:
    """Seats per value for paths of at most ``most_values`` values (at most 40, so that 64 bits tell them from many).

    Paths of many values, such as ids, drop out by a bit set before values are grouped; those that are left are counted exactly.
    """
    if not 0 < most_values <= 40:
        raise ValueError("most_values must lie between 1 and 40")
    keys = ["signal", "path"]
    own = recs.select("signal", F.coalesce(F.element_at("resource", seat), F.element_at("attrs", seat)).alias("seat"), "attrs")
    flat = written(own, "records").select("signal", "seat", F.explode("attrs").alias("path", "value"))
    g = flat.join(few_valued(flat, keys, most_values), keys, "left_semi").groupBy(*keys, "value").agg(F.count_distinct("seat").alias("seats"))
    g = written(g, "reach")
    few = g.groupBy(*keys).agg(F.count("*").alias("n")).where(col("n") <= most_values)
    return g.join(few, keys, "left_semi")


def with_status(paths: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The decision for (signal, name, path): of the exact name, else of any name, else of resources."""
    c = catalogue.select("signal", "name", "path", "status")
    exact = F.broadcast(c.where("name <> '*'").withColumnRenamed("status", "s1"))
    wide = F.broadcast(c.where("name = '*'").select("signal", "path", col("status").alias("s2")))
    shared = F.broadcast(c.where("name = '*' AND signal = 'resource'").select("path", col("status").alias("s3")))
    out = paths.join(exact, ["signal", "name", "path"], "left").join(wide, ["signal", "path"], "left").join(shared, "path", "left")
    return out.withColumn("status", F.coalesce("s1", "s2", "s3")).drop("s1", "s2", "s3")


def sweep(paths: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Paths that nobody decided on, and denied ones that got through."""
    s = with_status(paths.select("signal", "name", "path").distinct(), catalogue)
    return s.where(col("status").isNull() | (col("status") == "denied")).select("signal", "name", "path", F.coalesce("status", F.lit("unclassified")).alias("finding"))


def promotion_candidates(profile: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Kept and undecided paths by fill; those that resources carry too are left out."""
    shared = profile.where("signal = 'resource'").select("path").distinct()
    s = with_status(profile.where("signal <> 'resource'").join(shared, "path", "left_anti"), catalogue)
    s = s.where(col("status").isNull() | (col("status") == "kept"))
    return s.orderBy(col("share").desc(), col("records").desc(), "signal", "name", "path")


def drift_constant(attrs: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Claims of one value that do not hold."""
    claims = F.broadcast(catalogue.where("basis = 'constant'").select("signal", "path"))
    return attrs.join(claims, ["signal", "path"]).groupBy("signal", "path").agg(F.count_distinct("value").alias("values")).where(col("values") > 1)


def drift_collinear(recs: DataFrame, catalogue: DataFrame, signal: str) -> DataFrame:
    """Claims that a partner determines a key: partner values with several claims. Absence counts as a value."""
    out = None
    for c in catalogue.where((col("basis") == "collinear") & (col("signal") == signal)).orderBy("path").collect():  # catalogue rows
        pair = recs.where(col("signal") == signal).select(F.element_at("attrs", c["path"]).alias("claim"), F.element_at("attrs", c["partner"]).alias("partner")).distinct()
        g = pair.groupBy("partner").agg(F.count("*").alias("claims")).where(col("claims") > 1).agg(F.count("*").alias("broken"))
        one = g.select(F.lit(c["path"]).alias("path"), F.lit(c["partner"]).alias("partner"), "broken")
        out = one if out is None else out.unionByName(one)
    return out


def drift_thin(recs: DataFrame, catalogue: DataFrame, *, share: float = 0.5, least_seats: int = 10, seat: str = "user.email") -> DataFrame:
    """Claims of little reach that reach half of the reporting seats; not judged below ten seats."""
    claims = F.broadcast(catalogue.where("basis = 'thin'").select("signal", "path"))
    own = recs.withColumn("seat", F.coalesce(F.element_at("resource", seat), F.element_at("attrs", seat)))
    total = own.agg(F.count_distinct("seat").alias("total"))
    reach = own.select("signal", "seat", F.explode(F.map_keys("attrs")).alias("path")).join(claims, ["signal", "path"]).groupBy("signal", "path").agg(F.count_distinct("seat").alias("seats"))
    return reach.crossJoin(total).where((col("total") >= least_seats) & (col("seats") >= share * col("total")))  # one row


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, non_null_pct, distinct, unique_pct) in one scan: each column's values are counted in parts, then put together."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), col(f"`{c}`").cast("string").alias("value")) for c in columns]))
    values = df.select(each.alias("x")).groupBy("x.column", "x.value").agg(F.count("*").alias("n"))
    g = values.groupBy("column").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(col("value").isNotNull(), col("n"))), F.lit(0)).alias("filled"), F.count("value").alias("distinct"))
    return g.select("column", F.round(100 * col("filled") / col("n"), 4).alias("non_null_pct"), "distinct", F.round(100 * F.try_divide("distinct", "filled"), 4).alias("unique_pct"))


def signal_profile(df: DataFrame, name: str, time: str) -> DataFrame:
    """Rows, share and first and last day of each name."""
    g = df.groupBy(name).agg(F.count("*").alias("rows"), F.min(time).cast("date").alias("first_day"), F.max(time).cast("date").alias("last_day"))
    return g.withColumn("share", F.round(col("rows") / F.sum("rows").over(Window.partitionBy(F.lit(0))), 6))


def unknown_literals(df: DataFrame, name: str, known: list[str]) -> DataFrame:
    """Names in the data that the catalogue does not list; no name is none of them."""
    return df.groupBy(name).agg(F.count("*").alias("rows")).where(~F.coalesce(col(name).isin(*known), F.lit(False)))


def top_values(attrs: DataFrame, path: str | Column, *, k: int = 50) -> DataFrame:
    """The k most frequent values of one path; ties by value."""
    return attrs.where(col("path") == path).groupBy("value").agg(F.count("*").alias("n")).orderBy(col("n").desc(), "value").limit(k)
