"""The yearly summary (J1, J2) and the share of titles from abroad (E3) kept beside a catalog store and changed by loads, not recomputed.

Per load, under ``<store>/_summary/v=N/``::

    keys/        partial sums of every (key, year) of the load, and the key's weight
    lands/       the distinct (key, country) rows of the load
    seen/        of every (key, year): the countries it lists, the only one if so, that it lists any
    years/       what the load changes in the sums of each year
    year_lands/  what it changes in the number of keys behind each (year, country)
    year_seen/   what it changes in the number of keys behind these
    _COMPLETE    written last; the load's identity

A load replaces its keys whole, so a key's partials follow from the load's own rows. What
it changes is these, minus the partials that the same keys had before: only the rows of
touched keys are looked up, in files sorted by key. All changes are sums, so the summary of
any number of loads is one small aggregation over ``years``, ``year_lands`` and ``year_seen``. Distinct counts
merge in this way too: a key is counted once by the load that holds it last. Sums of
whole minutes and years are exact in doubles up to 2**53, whatever the order.

One job at a time keeps a summary (the scheduler's job after the load).
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, functions as F, types as T

from marquee.functions import pct, safe_ratio, split_list, year_of
from marquee.operators import reports as R
from marquee.schema import HOME_COUNTRY, KEY, LATEST_YEARS, UNKNOWN
from marquee.sources.store import MARKER, VERSION_COL, CatalogStore

SUMS = ["rows", "titles", "movies", "shows", "minutes", "timed", "lag", "lagged"]
_YEAR = T.StructField("year_added", T.LongType())
_SCHEMAS = {
    "keys": T.StructType([T.StructField(KEY, T.StringType()), _YEAR, *(T.StructField(c, T.DoubleType()) for c in SUMS)]),
    "lands": T.StructType([T.StructField(KEY, T.StringType()), T.StructField("country", T.StringType())]),
    "years": T.StructType([_YEAR, *(T.StructField(c, T.DoubleType()) for c in SUMS)]),
    "year_lands": T.StructType([_YEAR, T.StructField("country", T.StringType()), T.StructField("keys", T.LongType())]),
}
_SEEN = [_YEAR, T.StructField("what", T.StringType()), T.StructField("country", T.StringType()), T.StructField("n", T.LongType())]
_SCHEMAS |= {"seen": T.StructType([T.StructField(KEY, T.StringType()), *_SEEN]), "year_seen": T.StructType(_SEEN)}
#: What the rows of ``seen`` count: a listed country, a country that is the only one, keys with any, rows without a key.
LISTS, ONLY, ANY, KEYLESS = "lists", "only", "any", "keyless"


class OutdatedSummaryError(RuntimeError):
    """The summary can't take a load in any more; rebuild it."""


def key_sums(titles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(keys, lands) of title rows: each (key, year) adds its sums to its year, weighted by the key's country rows."""
    per_year_key, listed = R.summary_partials(titles, exclude=UNKNOWN)
    # the key's country rows are the tokens of its lists, counted without dealing them out
    n_listed = titles.where(F.col(KEY).isNotNull() & (F.col("country") != F.lit(UNKNOWN))).groupBy(KEY).agg(
        F.sum(F.size(split_list("country"))).alias("_n"))
    rows = per_year_key.join(n_listed, KEY, "left")
    w, has_key = F.coalesce("_n", F.lit(1)), F.col(KEY).isNotNull()
    flag = lambda c: F.when(has_key & c, 1).otherwise(0)
    sums = {"rows": F.col("_r"), "titles": flag(F.lit(True)), "movies": flag(F.col("_mv") == 1), "shows": flag(F.col("_sh") == 1),
            "minutes": w * F.coalesce("_sm", F.lit(0)), "timed": w * F.col("_cm"),
            "lag": w * F.coalesce("_sl", F.lit(0)), "lagged": w * F.col("_cl")}
    return (rows.select(KEY, "year_added", *[c.cast("double").alias(n) for n, c in sums.items()]),
            listed.select(KEY, F.col("_country").alias("country")))


def key_seen(titles: DataFrame) -> DataFrame:
    """(key, year_added, what, country, n) of title rows: what each key adds to the distinct counts of its years."""
    tokens = R.explode_list(titles, "country", "_v", key=KEY, exclude=UNKNOWN, keep=["date_added"])
    year = year_of("date_added").alias("year_added")
    each = tokens.groupBy(KEY, year, F.col("_v").alias("country")).agg(F.count(F.lit(1)).alias("n"))
    of_key = each.groupBy(KEY, "year_added").agg(F.min("country").alias("low"), F.max("country").alias("high"), F.sum("n").alias("n"))
    keyed, one = F.col(KEY).isNotNull(), F.lit(1).cast("long").alias("n")
    none = F.lit(None).cast("string").alias("country")
    return _union([each.where(keyed).select(KEY, "year_added", F.lit(LISTS).alias("what"), "country", one),
                   of_key.where(keyed & (F.col("low") == F.col("high"))).select(KEY, "year_added", F.lit(ONLY).alias("what"), F.col("low").alias("country"), one),
                   of_key.where(keyed).select(KEY, "year_added", F.lit(ANY).alias("what"), none, one),
                   of_key.where(~keyed).select(KEY, "year_added", F.lit(KEYLESS).alias("what"), none, "n")])


def _year_seen(seen: DataFrame, sign: int) -> DataFrame:
    return seen.select("year_added", "what", "country", (F.col("n") * sign).alias("n"))


def _years(keys: DataFrame, sign: int) -> DataFrame:
    return keys.select("year_added", *[(F.col(c) * sign).alias(c) for c in SUMS])


def _year_lands(keys: DataFrame, lands: DataFrame, sign: int) -> DataFrame:
    both = keys.where(F.col(KEY).isNotNull()).select(KEY, "year_added").join(lands, KEY)
    return both.groupBy("year_added", "country").agg((F.count(F.lit(1)) * sign).alias("keys"))


class CatalogSummary:
    def __init__(self, store: CatalogStore):
        self.store, self.spark = store, store.spark
        self.root = f"{store.root}/_summary"
        self._touched = f"{self.root}/_touched"         # of the load being taken in: its keys' last earlier loads

    def _dir(self, v: int) -> str:
        return f"{self.root}/{VERSION_COL}={v:06d}"

    def applied(self) -> dict[int, dict]:
        """Loads that the summary holds, and their facts."""
        inner = CatalogStore(self.spark, self.root)
        return {v: json.loads(inner.read_text(f"{self._dir(v)}/{MARKER}")) for v in inner.versions()}

    def _scan(self, kind: str, versions: list[int]) -> DataFrame:
        schema = T.StructType([*_SCHEMAS[kind].fields, T.StructField(VERSION_COL, T.IntegerType())])
        return (self.spark.read.schema(schema).option("basePath", self.root)
                .parquet(*[f"{self._dir(v)}/{kind}" for v in versions]))

    # ------------------------------------------------------------ write
    def refresh(self) -> list[int]:
        """Take in every complete load that the summary doesn't hold yet; returns their numbers."""
        parts, done = self.store.parts(), self.applied()
        self._check(done)
        start = next((v for v, f in done.items() if f.get("whole")), None)
        if not done and parts.base:                     # begin with a compacted store: all of it as one load
            titles = self.store.read()[0]
            keys, lands = key_sums(titles)
            last = max(parts.all)
            _, _, seen = self._store_all(last, {"keys": keys, "lands": lands, "seen": key_seen(titles)})
            self._write(last, _years(keys, 1), _year_lands(keys, lands, 1), _year_seen(seen, 1), {"whole": parts.all})
            return [last]
        held = set(done) | {v for f in done.values() for v in f.get("whole", [])}
        new = [v for v in parts.loads if v not in held]
        if parts.upto > max(held, default=0) or start and any(v < start for v in new):
            raise OutdatedSummaryError(f"loads of {self.store.root} were compacted before the summary took them in; rebuild it")
        for v in new:
            self._take(v, parts.facts[v].get("batch"))
        return new

    @staticmethod
    def _check(done: dict[int, dict]) -> None:
        if not all(f.get("seen") for f in done.values()):
            raise OutdatedSummaryError("the summary was begun before it kept shares; rebuild it")

    def rebuild(self) -> list[int]:
        """Begin again from the tables as they are."""
        self.store._fs.delete(self.store._Path(self.root), True)
        return self.refresh()

    def _take(self, v: int, batch: str | None) -> None:
        done = self.applied()
        earlier, later = [u for u in done if u < v], [u for u in done if u > v]
        titles = self.store.read_load(v)[0]
        (keys, lands), seen = key_sums(titles), key_seen(titles)
        replaced = batch is not None and any(done[u].get("batch") == batch for u in later)
        if replaced:
            # a later load of the same identity has replaced these
            keys, seen = keys.where(F.col(KEY).isNotNull()), seen.where(F.col(KEY).isNotNull())
        if later:                                       # a load that finished late: keys of later loads stay as they are
            gone = self._scan("keys", later).where(F.col(KEY).isNotNull()).select(KEY).distinct()
            keys, lands, seen = (df.join(gone, KEY, "left_anti") for df in (keys, lands, seen))
        keys, lands, seen = self._store_all(v, {"keys": keys, "lands": lands, "seen": seen})
        years, year_lands, year_seen = [_years(keys, 1)], [_year_lands(keys, lands, 1)], [_year_seen(seen, 1)]
        if earlier:
            old_keys, old_lands, old_seen = self._before(keys, earlier)
            years.append(_years(old_keys, -1))
            year_seen.append(_year_seen(old_seen, -1))
            year_lands.append(_year_lands(old_keys, old_lands, -1))
            same = [u for u in earlier if batch is not None and done[u].get("batch") == batch]
            if same and not replaced:                   # the identity's last load so far gives up its rows without a key
                years.append(_years(self._scan("keys", same[-1:]).where(F.col(KEY).isNull()), -1))
                year_seen.append(_year_seen(self._scan("seen", same[-1:]).where(F.col(KEY).isNull()), -1))
        self._write(v, _union(years), _union(year_lands), _union(year_seen), {"batch": batch} if batch else {})
        self.store._fs.delete(self.store._Path(self._touched), True)

    def _before(self, keys: DataFrame, earlier: list[int]) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(keys, lands, seen) rows that the touched keys have had: those of the last earlier load that holds each."""
        low, high = keys.agg(F.min(KEY), F.max(KEY)).first()
        touched = keys.where(F.col(KEY).isNotNull()).select(KEY).distinct()
        near = F.col(KEY).between(F.lit(low), F.lit(high)) if low is not None else F.lit(False)     # reaches the scan
        held = self._scan("keys", earlier).where(near).select(KEY, VERSION_COL).join(touched, KEY, "left_semi")
        # found once, read by the three changes
        held.groupBy(KEY).agg(F.max(VERSION_COL).alias(VERSION_COL)).write.mode("overwrite").parquet(self._touched)
        last = self.spark.read.schema(held.schema).parquet(self._touched)
        return tuple(self._scan(kind, earlier).where(near).join(last, [KEY, VERSION_COL]) for kind in ("keys", "lands", "seen"))

    def _store_all(self, v: int, frames: dict[str, DataFrame]) -> list[DataFrame]:
        """The tables are independent jobs: they run side by side."""
        with ThreadPoolExecutor(max_workers=len(frames)) as pool:
            return list(pool.map(lambda kind: self._store(v, kind, frames[kind]), frames))

    def _store(self, v: int, kind: str, df: DataFrame) -> DataFrame:
        typed = df.select(*[F.col(f.name).cast(f.dataType) for f in _SCHEMAS[kind].fields])
        if KEY in typed.columns:
            typed = typed.sortWithinPartitions(KEY)
        typed.write.mode("overwrite").parquet(f"{self._dir(v)}/{kind}")      # a crashed attempt is replaced
        return self._scan(kind, [v]).drop(VERSION_COL)

    def _write(self, v: int, years: DataFrame, year_lands: DataFrame, year_seen: DataFrame, facts: dict) -> None:
        self._store_all(v, {
            "years": years.groupBy("year_added").agg(*[F.sum(c).alias(c) for c in SUMS]),
            "year_lands": year_lands.groupBy("year_added", "country").agg(F.sum("keys").alias("keys")),
            "year_seen": year_seen.groupBy("year_added", "what", "country").agg(F.sum("n").alias("n"))})
        self.store._write_text(f"{self._dir(v)}/{MARKER}", json.dumps(facts | {"seen": True}))

    # ------------------------------------------------------------ read
    def read(self, digits: int = 1) -> DataFrame:
        """J1 as of the loads that were taken in."""
        versions = list(self.applied())
        if not versions:
            return R.yearly_summary(self.store.read()[0], exclude=UNKNOWN)
        years = self._scan("years", versions).groupBy("year_added").agg(*[F.sum(c).alias(c) for c in SUMS]).where("rows > 0")
        lands = self._scan("year_lands", versions).groupBy("year_added", "country").agg(F.sum("keys").alias("keys")).where("keys > 0")
        lands = lands.groupBy(F.col("year_added").alias("_y")).agg(F.count(F.lit(1)).alias("_c"))
        both = years.join(lands, F.col("year_added").eqNullSafe(F.col("_y")), "left")
        mean = lambda total, n: F.round(safe_ratio(F.col(total), F.col(n)), digits)
        return R.sorted_by(both.select(
            "year_added", F.col("titles").cast("bigint").alias("total_titles"), F.col("movies").cast("bigint").alias("movies"),
            F.col("shows").cast("bigint").alias("tv_shows"), mean("minutes", "timed").alias("avg_movie_minutes"),
            F.coalesce("_c", F.lit(0)).cast("bigint").alias("distinct_countries"), mean("lag", "lagged").alias("avg_acquisition_lag_years")),
            "year_added")

    def latest(self, k: int = LATEST_YEARS) -> DataFrame:
        """J2 as of the loads that were taken in."""
        return R.latest(self.read(), k)

    def share(self, home: str = HOME_COUNTRY, digits: int = 1) -> DataFrame:
        """E3 as of the loads that were taken in, for any home country."""
        done = self.applied()
        self._check(done)
        if not done:
            return R.sorted_by(R.distinct_share_by_period(self.store.read()[0], "country", home, exclude=UNKNOWN, match_out="us_titles",
                                                          other_out="non_us_titles", share_out="non_us_share_pct", digits=digits), "year_added")
        what, at_home = F.col("what"), F.col("country") == F.lit(home)
        total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("bigint")
        sums = self._scan("year_seen", list(done)).groupBy("year_added").agg(
            total((what == LISTS) & at_home).alias("us_titles"), total(what == ANY).alias("listed"),
            total((what == ONLY) & at_home).alias("home_only"), total(what == KEYLESS).alias("keyless"))
        sums = sums.where("listed > 0 or keyless > 0").withColumn("non_us_titles", F.col("listed") - F.col("home_only"))
        return R.sorted_by(sums.select("year_added", "us_titles", "non_us_titles",
                                       pct(F.col("non_us_titles"), F.col("listed"), digits).alias("non_us_share_pct")), "year_added")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out
