"""Objects on the tiles of the survey.

The tile of an object is the first of the four nearest tiles there are whose
footprint holds it. Candidates come from grid arithmetic, sixteen for an
object and some more at ra 0, and meet the tiles in a broadcast join, so no
distance is computed between all objects and all tiles. Objects are shuffled
once, by their key and before they become candidates; those of an object then come
together where they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sky
from . import availability

NEAREST = 4
#: Greatest grid numbers: a grid has no more than 721 x 361 tiles, whatever the survey.
MOST_X, MOST_Y = 720, 360


def candidates(objects: DataFrame) -> DataFrame:
    """objects with a row for each candidate: xxx and yyy, null for those outside the grid; a candidate may come twice."""
    steps = F.array(*(F.lit(k) for k in range(-1, 3)))
    rows = objects.withColumn("yyy", F.explode(steps)).withColumn("yyy", F.floor((F.col("dec") + 90) * 2).cast("int") + F.col("yyy"))
    rows = rows.withColumn("_c", F.greatest(F.lit(0.0), F.cos(F.radians(F.col("yyy") / F.lit(2.0) - 90))))
    rows = rows.withColumns({"_x": F.floor(F.col("ra") * 2 * F.col("_c")).cast("int"), "_low": F.floor(F.col("_c") * 720).cast("int"), "_high": F.ceil(F.col("_c") * 720).cast("int")})
    # Near ra 0 the columns at the other end of the row as well; its length is no whole number, and as numbers come
    # from positions within a tile's row and not from its centre, it goes up to seven columns beyond ra 360.
    seam = (F.col("_x") <= 9) | (F.col("_x") + 2 >= F.col("_low"))
    shifts = F.when(seam, F.array(F.lit(0), "_low", "_high", -F.col("_low"), -F.col("_high"))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("_s", F.explode(shifts)).withColumn("_k", F.explode(steps)).withColumn("_x", F.col("_x") + F.col("_s") + F.col("_k"))
    ok = F.col("_x").between(0, MOST_X) & F.col("yyy").between(0, MOST_Y)
    return rows.select(*objects.columns, F.when(ok, F.col("_x")).alias("xxx"), F.when(ok, F.col("yyy")).alias("yyy"))


def assign(objects: DataFrame, tiles: DataFrame, key: str = "ID", nearest: int = NEAREST) -> DataFrame:
    """objects with xxx, yyy, tile, x and y, and what else tiles has; null where no tile holds them.

    key is unique in objects; tiles: xxx, yyy (each pair once) and more."""
    extra = [c for c in tiles.columns if c not in ("xxx", "yyy")]
    ra0, dec0 = sky.tile_centre(F.col("xxx"), F.col("yyy"))
    placed = tiles.where(F.col("xxx").between(0, MOST_X) & F.col("yyy").between(0, MOST_Y)).withColumns({"_ra0": ra0, "_dec0": dec0})
    placed = placed.select("xxx", "yyy", "_ra0", "_dec0", F.struct(*sky.unit_vector(F.col("_ra0"), F.col("_dec0"))).alias("_v0"), *extra)
    # Dealt by key before a row becomes many: the one shuffle, and a small input still keeps all cores busy.
    dealt = objects.repartition(int(objects.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col(key))
    own = dealt.select(F.struct(*objects.columns).alias("_o"), F.col(key).alias("_key"), "ra", "dec", F.struct(*sky.unit_vector(F.col("ra"), F.col("dec"))).alias("_v"))
    # At most MOST_X x MOST_Y tiles, so their broadcast is bounded.
    met = candidates(own).join(F.broadcast(placed), ["xxx", "yyy"], "left")
    parts = lambda c: tuple(F.col(f"{c}.col{i}") for i in (1, 2, 3))
    away = sky.chord(parts("_v"), parts("_v0"))
    x, y = sky.pixel(F.col("ra"), F.col("dec"), F.col("_ra0"), F.col("_dec0"))
    found = F.when(F.col("_ra0").isNotNull(), F.struct(away.alias("away"), "xxx", "yyy", x.alias("x"), y.alias("y"), *extra))
    # At most some twenty candidates for an object, each once.
    ranked = F.slice(F.array_sort(F.collect_set("_t")), 1, nearest)
    one = met.select("_key", "_o", found.alias("_t")).groupBy("_key").agg(F.first("_o").alias("_o"), ranked.alias("_r"))
    best = F.get(F.filter("_r", lambda t: sky.on_tile(t.x, t.y)), F.lit(0))
    out = one.select("_o", best.alias("_t")).select("_o.*", *(F.col(f"_t.{c}").alias(c) for c in ("xxx", "yyy", "x", "y", *extra)))
    return out.withColumn("tile", F.when(F.col("xxx").isNotNull(), sky.tile_name(F.col("xxx"), F.col("yyy"))))


def with_bands(objects: DataFrame, avail: DataFrame, order: list[str], key: str = "ID") -> DataFrame:
    """objects with their tile, pixel, bands and n_bands."""
    out = assign(objects, availability.by_tile(avail, order).drop("band_list"), key)
    return out.withColumns({"bands": F.coalesce("bands", F.lit("")), "n_bands": F.coalesce("n_bands", F.lit(0))})
