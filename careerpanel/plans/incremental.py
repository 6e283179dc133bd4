"""A panel that is kept up to date: deliveries arrive exactly once, and only the persons in them are computed anew."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careerpanel.functions.people import People
from careerpanel.plans.pipeline import PanelRun, finish_panel, impute_people, run_panel
from careerpanel.schema import PANEL, conform
from careerpanel.sources.ingest import BATCH_SIZE, assign_batches
from careerpanel.sources.staging import remove, scratch, stage
from careerpanel.sources.store import LEDGER, EpisodeStore, folder_of, read_folders, write_folders

PERSONS = "persnr bigint, pn_batch bigint, load string"


@dataclass(frozen=True)
class PanelStore:
    """Episodes, the state of persons, and the panel, each in folders by batches (``folder_of``).

    ``deliver`` takes episodes, ``refresh`` brings the panel up to date. A person stays in the batch that their first
    delivery put them in, so whatever concerns them lies in one folder. The state of a person is their prepared rows:
    biographies, lookups and observed wages, all that the imputation starts from. Both steps may be
    repeated after they broke off: what isn't in a ledger is done again, and done again it gives the same.
    """

    spark: SparkSession
    path: str
    size: int = BATCH_SIZE

    @property
    def episodes(self) -> EpisodeStore:
        return EpisodeStore(self.spark, f"{self.path}/episodes")

    def _table(self, name: str, schema: str | None = None) -> DataFrame | None:
        folder = f"{self.path}/{name}"
        if not self.episodes.exists(folder):
            return None if schema is None else self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(folder) if schema is None else self.spark.read.schema(schema).parquet(folder)

    def persons(self) -> DataFrame:
        """(persnr, pn_batch) of all persons of complete deliveries."""
        loads = self.episodes.ledger().select("load").distinct()
        return self._table("persons", PERSONS).join(F.broadcast(loads), "load", "left_semi").select("persnr", "pn_batch")  # a row per load

    def deliver(self, df: DataFrame, load: str) -> DataFrame:
        """Adds the episodes of a delivery; the batches that it added rows to, none if it was complete before.

        Known persons go to their batch, new ones to new batches behind the last.
        """
        with scratch(self.spark):
            df = conform(df).drop("pn_batch", "load")
            known = stage(self.persons(), "persons")
            top = known.agg(F.max("pn_batch")).first()[0] or 0
            new = assign_batches(df.join(known, "persnr", "left_anti"), self.size)
            new = stage(new.withColumn("pn_batch", F.col("pn_batch") + top), "new-persons")
            index = new.select("persnr", "pn_batch", F.lit(load).alias("load")).distinct()
            index.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(f"{self.path}/persons")
            rows = df.join(known, "persnr").unionByName(new)
            added = self.episodes.append(rows, load)
            return self.spark.createDataFrame(added.toArrow(), LEDGER)  # a row per batch

    def pending(self) -> DataFrame:
        """(load, pn_batch) of deliveries that the panel doesn't know yet."""
        done = self._table("done", "load string, pn_batch bigint")
        return self.episodes.ledger().join(done, ["load", "pn_batch"], "left_anti").select("load", "pn_batch")

    def touched_rows(self, pending: DataFrame) -> DataFrame:
        """The episodes of all persons in the pending deliveries. Folders without these batches aren't read."""
        batches = [r["pn_batch"] for r in pending.select("pn_batch").distinct().collect()]  # those of the deliveries
        rows = self.episodes.read(batches)
        persons = rows.join(F.broadcast(pending), ["load", "pn_batch"], "left_semi").select("persnr").distinct()
        return rows.join(stage(persons, "touched"), "persnr", "left_semi").drop("load")

    def wages(self) -> tuple[DataFrame | None, float | None]:
        """The fits and the bound that the panel's wages are imputed with."""
        fits = self._table("wages")
        if fits is None:
            return None, None
        return fits.drop("bound"), fits.select("bound").first()["bound"]

    def _keep_wages(self, fits: DataFrame, bound: float | None) -> None:
        fits.withColumn("bound", F.lit(bound).cast("double")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/wages")

    def refresh(self, **options) -> PanelRun | None:
        """Computes the persons of pending deliveries anew and replaces their rows in state and panel.

        The first refresh fits the wage regression; later ones impute with its fits and bound, so the rows of all
        others stay right, until ``refit``. The result equals the whole job on all deliveries with the same fits
        and bound. ``options`` are those of ``run_panel``. None if nothing is pending.
        """
        with scratch(self.spark):
            pending = self.spark.createDataFrame(self.pending().toArrow(), "load string, pn_batch bigint")  # a row per batch
            if pending.isEmpty():
                return None
            rows = stage(self.touched_rows(pending), "touched-rows")
            fits, bound = self.wages()
            run = run_panel(rows, fits=fits, bound=bound, keep=("pn_batch",), **options)
            if fits is None:
                self._keep_wages(run.fits, run.bound)
            persons = rows.select("persnr", "pn_batch").distinct()
            self._replace("state", run.prepared.merged(), persons)
            self._replace("panel", run.panel, persons)
            pending.coalesce(1).write.mode("append").parquet(f"{self.path}/done")
            return run

    def _replace(self, name: str, new: DataFrame, persons: DataFrame) -> None:
        """The rows of ``persons`` in a table are replaced by ``new``, in the folders of their batches alone."""
        path = f"{self.path}/{name}"
        touched = persons.select(folder_of(F.col("pn_batch")).alias("_folder")).distinct()
        folders = [r["_folder"] for r in touched.collect()]
        whole, before = new, {}
        if self.episodes.exists(path):
            old = read_folders(self.spark, path).where(folder_of(F.col("_folder")).isin(folders))
            files = old.groupBy("_folder").agg(F.max("_metadata.file_name").alias("file"))
            before = {r["_folder"]: r["file"] for r in files.collect()}  # a row per folder
            whole = new.unionByName(old.drop("_folder").join(persons.select("persnr"), "persnr", "left_anti"))
        # what is read here is replaced when all tasks have ended
        write_folders(whole.withColumn("_folder", folder_of(F.col("pn_batch"))), path, order=("_batch", "persnr"))
        for folder, file in before.items():
            if self.episodes.exists(f"{path}/pn_batch={folder}/{file}"):  # no rows are left that replace it
                remove(self.spark, f"{path}/pn_batch={folder}")

    def refit(self, handling: str = "wage", cutoff: tuple[int, int] = (6, 30), seed: int = 0, compat: bool = False) -> None:
        """Fits the wages of all persons anew, from their state, and rebuilds the panel; biographies stay."""
        with scratch(self.spark):
            if not self.episodes.exists(f"{self.path}/state"):
                raise ValueError(f"{self.path} has no state yet")
            state = read_folders(self.spark, f"{self.path}/state").drop("_folder")
            imputed, fits, bound = impute_people(People(state), seed, compat, None)
            panel = stage(finish_panel(imputed.merged(), handling, *cutoff, keep=("pn_batch",)).select(*PANEL, "pn_batch"), "panel")
            self._replace("panel", panel, stage(state.select("persnr", "pn_batch").distinct(), "persons"))
            self._keep_wages(fits, bound)

    def panel(self) -> DataFrame:
        """The panel as of the last refresh, with ``pn_batch``."""
        if not self.episodes.exists(f"{self.path}/panel"):
            raise ValueError(f"{self.path} has no panel yet")
        return read_folders(self.spark, f"{self.path}/panel").select(*PANEL, "pn_batch")
