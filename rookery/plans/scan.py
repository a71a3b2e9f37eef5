"""Countries asked of a map database statement by statement, and area by area where one answer would be too big.

The scan is a fixpoint over its own log: what has been asked, and what came of it, says what to ask next.  A step asks all
that is open at once, writes the answers, and then the log of the step as one committed file; a scan that was broken off
goes on from the last committed step, and a step that was not committed is asked again as a whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import sources
from ..operators import merge
from ..sources import files

#: The request for a country's areas, beside its statements 0, 1, ...
AREAS = -1
WORK = "cc string, area bigint, place int, statement int"
LOG = f"{WORK}, error string, step int"
ELEMENT = "type string, id bigint, tags map<string,string>"

Ask = Callable[[DataFrame], DataFrame]


class CountryScan:
    """A scan of ``countries(cc)`` kept in a folder.

    A country is asked for its first statement.  If that fails the country has failed, unless the error says that it is too
    big: then it is split.  If it succeeds the other statements are asked, once each; those that fail make the country
    partial.  A split country is asked for its areas, and each area for all statements until they all succeed in one step.
    ``most`` limits how often areas are asked for, and how often each of them is asked.
    """

    def __init__(self, spark: SparkSession, path: str, countries: DataFrame, statements: int = 4, most: int = 3):
        self.spark, self.path, self.statements, self.most = spark, path.rstrip("/"), statements, most
        self.countries = countries.select("cc").distinct()

    def steps(self) -> int:
        """Steps that are committed."""
        return len([x for x in files.names_in(self.spark, f"{self.path}/done") if not x.startswith(".")])

    def _read(self, name: str, schema: str) -> DataFrame:
        n = self.steps()
        paths = [f"{self.path}/{name}/step-{i}" for i in range(n)]
        return self.spark.read.schema(schema).parquet(*paths) if n else self.spark.createDataFrame([], schema)

    def log(self) -> DataFrame:
        """Every request with its error (null for an answer) and its step."""
        return self._read("log", LOG)

    def _asked(self) -> DataFrame:
        """``cc, first, split, others, areas_asked, areas_known``: how far each country is."""
        log = self.log()
        whole = F.col("area").isNull()
        first = whole & (F.col("statement") == 0)
        answered = F.col("error").isNull()
        return self.countries.join(
            log.groupBy("cc").agg(
                F.max(F.when(first, F.when(answered, "yes").otherwise("no"))).alias("first"),
                F.coalesce(F.bool_or(first & sources.is_too_big(F.col("error"))), F.lit(False)).alias("split"),
                F.count_if(whole & (F.col("statement") > 0)).alias("others"),
                F.count_if(F.col("statement") == AREAS).alias("areas_asked"),
                F.coalesce(F.bool_or((F.col("statement") == AREAS) & answered), F.lit(False)).alias("areas_known"),
            ),
            "cc",
            "left",
        )

    def areas(self) -> DataFrame:
        """``cc, area, place, tries, done``: the areas of split countries."""
        found = self.elements_of(AREAS).filter("type = 'relation'").groupBy("cc", "id").agg(F.min("ord").alias("ord"))
        place = F.row_number().over(Window.partitionBy("cc").orderBy("ord", "id"))  # a country's areas
        known = found.select("cc", sources.area_id(F.col("id")).alias("area"), place.alias("place"))
        tried = self.log().filter("area is not null").groupBy("cc", "area", "step").agg(F.bool_and(F.col("error").isNull()).alias("whole"))
        tried = tried.groupBy("cc", "area").agg(F.count("*").alias("tries"), F.bool_or("whole").alias("done"))
        return known.join(tried, ["cc", "area"], "left").fillna({"tries": 0, "done": False})

    def work(self) -> DataFrame:
        """``cc, area, place, statement``: what to ask next; nothing at the end."""
        asked, none = self._asked(), F.lit(None).cast("bigint")
        rest = F.explode(F.sequence(F.lit(1), F.lit(self.statements - 1))) if self.statements > 1 else F.explode(F.array().cast("array<int>"))
        whole = lambda rows, statement: rows.select("cc", none.alias("area"), F.lit(0).alias("place"), statement.alias("statement"))
        new = whole(asked.filter("first is null"), F.lit(0))
        others = whole(asked.filter("first = 'yes' and others = 0"), rest)
        split = whole(asked.filter(f"split and not areas_known and areas_asked < {self.most}"), F.lit(AREAS))
        inside = self.areas().filter(f"not done and tries < {self.most}")
        every = F.explode(F.sequence(F.lit(0), F.lit(self.statements - 1)))
        return new.unionByName(others).unionByName(split).unionByName(inside.select("cc", "area", "place", every.alias("statement")))

    def step(self, ask: Ask) -> bool:
        """Asks what is open; false if nothing was.

        ``ask`` gives ``cc, area, statement, error, elements`` for its rows.  An answer may come in several rows, one of which
        with an error makes it fail; a missing answer is an error.
        """
        n = self.steps()
        self.work().write.mode("overwrite").parquet(f"{self.path}/work/step-{n}")
        work = self.spark.read.schema(WORK).parquet(f"{self.path}/work/step-{n}")
        if work.isEmpty():
            return False
        ask(work).select("cc", "area", "statement", "error", F.col("elements").cast(f"array<struct<{ELEMENT}>>").alias("elements")).write.mode(
            "overwrite"
        ).parquet(f"{self.path}/answers/step-{n}")
        answers = self.spark.read.parquet(f"{self.path}/answers/step-{n}").alias("a")
        same = F.col("w.cc").eqNullSafe(F.col("a.cc")) & F.col("w.area").eqNullSafe(F.col("a.area")) & (F.col("w.statement") == F.col("a.statement"))
        error = F.coalesce("a.error", F.when(F.col("a.elements").isNull(), "no response"))
        rows = work.alias("w").join(answers, same, "left").select("w.*", error.alias("error"), "a.elements")
        asked = rows.groupBy(*(x.split()[0] for x in WORK.split(", "))).agg(F.max("error").alias("error"))
        asked.withColumn("step", F.lit(n)).write.mode("overwrite").parquet(f"{self.path}/log/step-{n}")
        each = rows.filter("error is null").select("cc", "area", "place", "statement", F.lit(n).alias("step"), F.posexplode("elements").alias("i", "e"))
        each.select("cc", "area", "place", "statement", "step", "i", "e.*").write.mode("overwrite").parquet(f"{self.path}/elements/step-{n}")
        files.write_file(self.spark, f"{self.path}/done/{n:06d}", "")
        return True

    def run(self, ask: Ask, most_steps: int = 100) -> None:
        """Steps until nothing is open."""
        for _ in range(most_steps):
            if not self.step(ask):
                return
        raise RuntimeError(f"the scan is not at its end after {most_steps} steps")

    def elements_of(self, *statements: int) -> DataFrame:
        """``cc, ord, type, id, tags`` of every element that the given statements were answered with, in the order of the answers."""
        rows = self._read("elements", f"cc string, area bigint, place int, statement int, step int, i int, {ELEMENT}")
        return rows.filter(F.col("statement").isin(*statements)).select("cc", F.struct("step", "place", "statement", "i").alias("ord"), "type", "id", "tags")

    def elements(self) -> DataFrame:
        """The elements of each country, each once: the last answer's content at the first one's place.  Half-read areas count as far as they were read."""
        rows = self.elements_of(*range(self.statements))
        return merge.latest_element(rows.withColumn("id", F.struct("cc", "id"))).select("id.cc", "type", "id.id", "ord", "tags")

    def states(self) -> DataFrame:
        """``cc, split, done, total, complete, partial, error`` of each country: areas read and known, statements that failed, why it failed as a whole."""
        log = self.log()
        failed = log.filter("area is null and error is not null").groupBy("cc").agg(
            F.count_if(F.col("statement") > 0).alias("failed"),
            F.max_by("error", F.struct("step", "statement")).alias("error"),
        )
        areas = self.areas().groupBy("cc").agg(F.count_if("done").alias("done"), F.count("*").alias("total"))
        rows = self._asked().join(failed, "cc", "left").join(areas, "cc", "left").fillna({"split": False, "done": 0, "total": 0, "failed": 0})
        lost = ((F.col("first") == "no") & ~F.col("split")) | (F.col("split") & (F.col("total") == 0))
        why = F.coalesce(F.when(F.col("split") & F.coalesce("areas_known", F.lit(False)), "no subdivisions found to split by"), "error")
        return rows.select(
            "cc",
            "split",
            "done",
            "total",
            (F.col("split") & (F.col("total") > 0) & (F.col("done") >= F.col("total"))).alias("complete"),
            F.when((F.col("failed") > 0) & ~F.col("split") & ~lost, F.col("failed")).alias("partial"),
            F.when(lost, why).alias("error"),
        )
