"""Stage registry: named steps in order, run over ranges, each writing a new version of its table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Stage:
    name: str
    needs: tuple[str, ...]
    run: Callable[..., DataFrame]


@dataclass
class Pipeline:
    """Stages over tables in one folder.  A stage reads the newest version of the tables it needs and writes the next version of its own."""

    spark: SparkSession
    folder: str
    stages: list[Stage] = field(default_factory=list)
    versions: dict[str, int] = field(default_factory=dict)

    def stage(self, name: str, *needs: str) -> Callable:
        def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            self.stages.append(Stage(name, needs, f))
            return f

        return register

    def put(self, name: str, df: DataFrame) -> None:
        """Write a table as its next version; older ones stay, as a backup."""
        version = self.versions.get(name, 0) + 1
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}/v={version}")
        self.versions[name] = version

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}/v={self.versions[name]}")

    def selected(self, start: str | None = None, stop: str | None = None, only: str | None = None) -> list[Stage]:
        names = [s.name for s in self.stages]
        for wanted in (start, stop, only):
            if wanted is not None and wanted not in names:
                raise ValueError(f"no stage {wanted}; there are {names}")
        if only:
            return [s for s in self.stages if s.name == only]
        return self.stages[names.index(start) if start else 0 : names.index(stop) + 1 if stop else None]

    def run(self, start: str | None = None, stop: str | None = None, only: str | None = None, dry_run: bool = False) -> list[str]:
        """Run the stages in order; an error ends the run and leaves earlier versions as they were.  Returns the names."""
        chosen = self.selected(start, stop, only)
        if not dry_run:
            for s in chosen:
                self.put(s.name, s.run(*[self.table(n) for n in s.needs]))
        return [s.name for s in chosen]


def gazetteer_pipeline(spark: SparkSession, folder: str, volumes: DataFrame, gazetteer: DataFrame, vocabulary: dict[str, str]) -> Pipeline:
    """From scanned volumes to matched places and features, with the rule backend."""
    from pyspark.sql import functions as F

    from lodestone.operators import extraction, reconcile, segment
    from lodestone.sources import sinks

    p = Pipeline(spark, folder)
    p.put("volumes", volumes)
    p.put("gazetteer", gazetteer)

    @p.stage("entries", "volumes")
    def entries(v: DataFrame) -> DataFrame:
        return segment.segment_entries(v).withColumn("entry_id", F.xxhash64("volume", "seq"))

    @p.stage("answers", "entries")
    def answers(e: DataFrame) -> DataFrame:
        asked = extraction.requests(e.where("kind = 'entry'"), "rules", "rules-short", "rules-long", "v1")
        return extraction.call(asked, extraction.rule_backend(vocabulary), extraction.valid_response(set(vocabulary.values())))

    @p.stage("places", "answers")
    def places(a: DataFrame) -> DataFrame:
        rows = sinks.place_rows(extraction.parse_responses(a.where("status = 'ok'")), F.lit(None).cast("string"))
        e = F.from_json("extraction", "latitude double, longitude double, country_code string")
        return rows.select("*", e.latitude.alias("lat"), e.longitude.alias("lon"), e.country_code.alias("country_code"), F.concat_ws("/", F.col("entry_id").cast("string"), F.col("ordinal").cast("string")).alias("key"))

    @p.stage("matches", "places", "gazetteer")
    def matches(pl: DataFrame, g: DataFrame) -> DataFrame:
        asked = pl.select("key", "name", "country_code", "lat", "lon", F.array().cast("array<string>").alias("parents"))
        return reconcile.reconcile(asked, g)

    @p.stage("features", "matches")
    def features(m: DataFrame) -> DataFrame:
        located = m.where("lat IS NOT NULL").withColumn("cert", reconcile.certainty(F.col("recon_pass")))
        return sinks.point_features(located.withColumnRenamed("key", "id"), ["id", "name", "cert"])

    return p
