"""The three layers on storage and the full reload of each."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode import schemas
from silverlode.job import Job
from silverlode.plans import audits, gold, profiles, reports, silver
from silverlode.sources import (
    BucketedTable,
    Buckets,
    Files,
    LoadFailed,
    RunLog,
    Written,
    extremes,
    read_bucketed,
    read_extract,
    rejected_lines,
    write_bucketed,
    write_version,
)

_SCHEMAS = {"bronze": schemas.BRONZE, "silver": schemas.SILVER, "gold": schemas.GOLD}

# Where a version that is laid out in buckets lies in its folder.
_BUCKETS = "/buckets"

Rows = Callable[[], DataFrame]


class SilverLoad(NamedTuple):
    """The log rows of a load of cleaned tables, and its checks by name."""

    log: DataFrame
    checks: dict[str, DataFrame]


class Warehouse:
    """Tables in versions under `root/<layer>/<table>`, the run log and the rejected lines.

    A load writes new versions beside the current ones, checks them and then publishes all of
    them at once, with one small file; until then, and for good if it fails, readers keep the
    versions of the last load. The tables of one load therefore always belong together. Views
    that were registered are registered anew after each load. The version before the current
    one is kept for queries that still read it, older ones are removed. One load at a time.

    `layouts` names the cleaned and gold tables, as (layer, table), that loads write in buckets by
    a key; the layout is stored with each version, so readers need not know it.
    """

    def __init__(
        self, job: Job, root: str | None = None,
        layouts: Mapping[tuple[str, str], Buckets] | None = None,
    ) -> None:
        self.job = job
        self.layouts = dict(layouts or {})
        for layer, table in self.layouts:
            if layer == "bronze" or table not in _SCHEMAS[layer]:
                raise ValueError(f"{layer}.{table} cannot be laid out in buckets")
        self.root = (root or f"{job.folder}/warehouse").rstrip("/")
        self.log = RunLog(job.spark, f"{self.root}/run_log")
        self.files = Files(job.spark)
        self._new: dict[tuple[str, str], str] = {}
        # What the last load wrote, by table.
        self._written: dict[str, Written] = {}
        self._has_views = False

    def versions(self, layer: str) -> dict[str, str]:
        """Published place of each table of a layer, below the layer's folder."""
        published = self._published(layer)
        return json.loads(self.files.read(published[-1])) if published else {}

    def _published(self, layer: str) -> list[str]:
        folder = f"{self.root}/{layer}/_published"
        names = self.files.names(folder)
        return [f"{folder}/{name}" for name in names if name.endswith(".json")]

    def path(self, layer: str, table: str) -> str:
        place = self._new.get((layer, table)) or self.versions(layer).get(table)
        if place is None:
            raise LookupError(f"{layer}.{table} was not loaded yet")
        return f"{self.root}/{layer}/{place}"

    def _size(self, layer: str) -> int:
        """Bytes of the published tables of a layer."""
        return sum(
            self.files.size(f"{self.root}/{layer}/{place}") for place in self.versions(layer).values()
        )

    def read(self, layer: str, table: str) -> DataFrame:
        schema, path = _SCHEMAS[layer][table], self.path(layer, table)
        rows = self.job.spark.read.schema(schema).parquet(path)
        # Buckets and hot keys lie in folders of their own, which Spark reads as a column.
        return rows.select(schema.fieldNames()) if path.endswith(_BUCKETS) else rows

    def bucketed(self, layer: str, table: str) -> BucketedTable:
        """A table that was loaded in buckets, for `bucketed_join`."""
        return read_bucketed(self.job, self.path(layer, table), _SCHEMAS[layer][table])

    def bronze(self, table: str) -> DataFrame:
        return self.read("bronze", table)

    def extremes(self, layer: str, table: str, *columns: str) -> DataFrame:
        """Two rows with the least and the greatest value of columns, from the file footers."""
        return extremes(self.job.spark, self.path(layer, table), _SCHEMAS[layer][table], columns)

    def sketches(self, layer: str, table: str) -> DataFrame:
        """The profile sketches of the current version: taken when first asked for, kept with the
        version and removed with it. Those of several versions or tables of one schema merge."""
        kept = f"{self.path(layer, table)}/_profile"
        if "_SUCCESS" not in self.files.names(kept):
            taken = profiles.profile_sketches(self.read(layer, table))
            taken.coalesce(1).write.mode("overwrite").parquet(kept)
        return self.job.spark.read.parquet(kept)

    def profile(self, layer: str, table: str) -> DataFrame:
        """Facts and estimates of every column of the current version (`merged_profile`)."""
        return profiles.merged_profile(self.sketches(layer, table), _SCHEMAS[layer][table])

    def silver(self, table: str) -> DataFrame:
        return self.read("silver", table)

    def gold(self, table: str) -> DataFrame:
        return self.read("gold", table)

    def rejects(self) -> DataFrame:
        """Every line that a load of extracts set aside: load_id, table_name, file, line."""
        spark, path = self.job.spark, f"{self.root}/bronze_rejects"
        if not self.files.names(path):
            return spark.createDataFrame([], schemas.REJECTS)
        return spark.read.schema(schemas.REJECTS).parquet(path)

    def load_extracts(
        self, folder: str, extracts: Iterable[schemas.Extract] = schemas.EXTRACTS,
        max_rejects: int | None = 0,
    ) -> DataFrame:
        """Load delimited extracts as they are into bronze tables; returns the log rows.

        Every line that does not fit its schema is kept in `rejects()`, also one with a quote
        that is never closed. More than `max_rejects` of them in one extract fail the load (None:
        any number is allowed).
        """
        spark = self.job.spark

        def steps(job: Job) -> list[dict[str, Rows]]:
            return [{extract.table: lambda extract=extract: read_extract(
                spark, f"{folder}/{extract.file}", schemas.BRONZE[extract.table], extract.quoted,
                job=job,
            ) for extract in extracts}]

        return self._load("bronze", steps, max_rejects)

    def load_bronze(self, tables: dict[str, DataFrame]) -> DataFrame:
        """Load raw rows that are DataFrames already."""
        steps = [{name: lambda rows=rows: rows for name, rows in tables.items()}]
        files = {file for rows in tables.values() for file in rows.inputFiles()}
        return self._load("bronze", lambda _: steps, size=sum(map(self.files.size, files)))

    def load_silver(self, max_issues: int | None = None) -> SilverLoad:
        """Clean every bronze table; returns the log rows and the checks of the load: rows of
        each table and diagnostics.

        The checks are taken while the tables are written, so nothing is read again for them. A
        table with more than `max_issues` exceptions in one of them fails the load before anything
        is published (None: any number is allowed).
        """
        log = self._load(
            "silver", self._silver_steps, max_issues=max_issues, size=self._size("bronze")
        )
        spark, written = self.job.spark, self._written
        counts = [(table, written[table].rows) for table in schemas.SILVER]
        issues = [(table, check, count) for table in schemas.SILVER
                  for check, count in written[table].facts.items()]
        target, metric, count = audits.LOAD_LABELS
        return SilverLoad(log, {
            "row counts": spark.createDataFrame(counts, "table_name string, row_count bigint"),
            "load diagnostics": spark.createDataFrame(
                issues, f"{target} string, {metric} string, {count} bigint"
            ),
        })

    def reload_silver(self, table: str, max_issues: int | None = None) -> SilverLoad:
        """Clean one bronze table anew; returns the log rows and the table's own audit."""
        def steps(job: Job) -> list[dict[str, Rows]]:
            return [{table: rows} for step in self._silver_steps(job)
                    for name, rows in step.items() if name == table]

        log = self._load("silver", steps, max_issues=max_issues, size=self._size("bronze"))
        return SilverLoad(log, self.audit_silver(table))

    def audit_silver(self, table: str) -> dict[str, DataFrame]:
        """The audit that belongs to one cleaned table, by the name of each check."""
        rows = self.silver(table)
        checks = {
            "crm_cust_info": lambda: {"repeated ids": audits.repeated_or_null(rows, "cst_id")},
            "crm_prd_info": lambda: {
                "repeated ids": audits.repeated_or_null(rows, "prd_id"),
                "untidy names": audits.untidy_product_names(rows),
                "reversed dates": audits.reversed_product_dates(rows),
                "malformed categories": audits.malformed_categories(rows),
                "doubtful costs or lines": audits.doubtful_costs_or_lines(rows),
            },
            "crm_sales_details": lambda: {
                "rules": audits.silver_rules(self.silver("crm_prd_info"), rows)
            },
            "erp_cust_az12": lambda: {"quality": audits.erp_customer_quality(self.job, rows)},
            "erp_loc_a101": lambda: {"quality": audits.location_quality(rows)},
            "erp_px_cat_g1v2": lambda: {"quality": audits.category_quality(rows)},
        }
        return checks[table]()

    def _silver_steps(self, job: Job) -> list[dict[str, Rows]]:
        """Locations come after the customers they refer to."""
        raw = self.bronze
        return [
            {
                "crm_cust_info": lambda: silver.clean_customers(raw("crm_cust_info")),
                "crm_prd_info": lambda: silver.clean_products(job, raw("crm_prd_info")),
                "crm_sales_details": lambda: silver.clean_sales(job, raw("crm_sales_details")),
                "erp_cust_az12": lambda: silver.clean_erp_customers(job, raw("erp_cust_az12")),
                "erp_px_cat_g1v2": lambda: silver.clean_categories(raw("erp_px_cat_g1v2")),
            },
            {
                "erp_loc_a101": lambda: silver.clean_locations(
                    job, raw("erp_loc_a101"), self.silver("crm_cust_info")
                ),
            },
        ]

    def load_gold(self) -> DataFrame:
        """Build dimensions and fact together, so that their surrogate keys agree."""
        clean = self.silver

        def steps(job: Job) -> list[dict[str, Rows]]:
            return [
                {
                    "dim_customer": lambda: gold.dim_customer(
                        job, clean("crm_cust_info"), clean("erp_cust_az12"), clean("erp_loc_a101")
                    ),
                    "dim_product": lambda: gold.dim_product(
                        job, clean("crm_prd_info"), clean("erp_px_cat_g1v2")
                    ),
                },
                {
                    "fact_sales": lambda: gold.fact_sales(
                        job, clean("crm_sales_details"), self.gold("dim_customer"),
                        self.gold("dim_product"),
                    ),
                },
            ]

        return self._load("gold", steps, size=self._size("silver"))

    def report_customers(self) -> DataFrame:
        return reports.report_customers(self.job, self.gold("dim_customer"), self.gold("fact_sales"))

    def report_products(self) -> DataFrame:
        return reports.report_products(self.job, self.gold("dim_product"), self.gold("fact_sales"))

    def register_views(self) -> None:
        """Make every loaded table and report a view named <layer>_<table> for SQL users; each
        load registers them anew, so they always show the current tables."""
        self._has_views = True
        for layer in _SCHEMAS:
            for table in self.versions(layer):
                self.read(layer, table).createOrReplaceTempView(f"{layer}_{table}")
        if self.versions("gold"):
            self.report_customers().createOrReplaceTempView("gold_report_customers")
            self.report_products().createOrReplaceTempView("gold_report_products")

    def _load(
        self, layer: str, plan: Callable[[Job], list[dict[str, Rows]]],
        max_rejects: int | None = None, max_issues: int | None = None, size: int = 0,
    ) -> DataFrame:
        """Load the tables of a layer, step by step, and publish them; returns the log rows.

        Shuffles are dealt for `size` bytes of input (`Job.shuffles_for`).

        The tables of one step do not need each other and are submitted together, so that a
        small one does not leave the cluster idle. The first error is raised once all tables of
        its step have ended, each with its own entry; later steps are not started. What the
        load staged is removed at its end.
        """
        started, load_id, work = time.monotonic(), uuid.uuid4().hex, self.job.part("load")
        checks = audits.load_checks() if layer == "silver" else {}
        self._written = {}

        def load(item: tuple[str, Rows]) -> int:
            table, built = item
            begun, refused = time.monotonic(), None
            try:
                frame = built()
                if layer == "silver":
                    frame = frame.withColumn(schemas.LOAD_TIME, F.current_timestamp())
                version = f"{self.root}/{layer}/{table}/{load_id}"
                layout = self.layouts.get((layer, table))
                target = version if layout is None else work.new_path(table)
                written = write_version(frame, target, checks.get(table))
                place, loaded, refused, issues = written
                if refused:
                    lines = rejected_lines(self.job.spark, version, load_id, table)
                    lines.write.mode("append").parquet(f"{self.root}/bronze_rejects")
                if max_rejects is not None and refused > max_rejects:
                    raise LoadFailed(
                        f"{layer}.{table}: {refused} rejected lines, {max_rejects} allowed"
                    )
                for check, count in issues.items():
                    if max_issues is not None and count > max_issues:
                        raise LoadFailed(
                            f"{layer}.{table}: {count} of {check}, {max_issues} allowed"
                        )
                if layout is not None:
                    rows = self.job.spark.read.schema(frame.schema).parquet(place)
                    place = f"{version}{_BUCKETS}"
                    write_bucketed(work, rows, place, layout)
            except Exception as error:
                seconds = time.monotonic() - begun
                self.log.add(layer, table, None, refused, seconds, "failed", str(error)[:2000])
                raise
            self._written[table] = written
            self._new[layer, table] = place.removeprefix(f"{self.root}/{layer}/")
            self.log.add(layer, table, loaded, refused, time.monotonic() - begun, "ok")
            return loaded

        total, status, message = 0, "failed", None
        try:
            with work.shuffles_for(size):
                for tables in plan(work):
                    with ThreadPoolExecutor(len(tables)) as pool:
                        total += sum(pool.map(load, tables.items()))
            self._publish(layer)
            status = "ok"
        except Exception as error:
            message = str(error)[:2000]
            for table in _SCHEMAS[layer]:
                self.files.remove(f"{self.root}/{layer}/{table}/{load_id}")
            raise
        finally:
            self._new.clear()
            work.remove()
            self.log.add(layer, "(all)", total, None, time.monotonic() - started, status, message)
            entries = self.log.write()
        if self._has_views:
            self.register_views()
        return entries

    def _publish(self, layer: str) -> None:
        """Make the new versions of this load the current ones, all at once, and remove the
        versions that neither this nor the last load published."""
        last = self.versions(layer)
        current = last | {table: place for (of, table), place in self._new.items() if of == layer}
        number = len(self._published(layer)) + 1
        self.files.write_new(f"{self.root}/{layer}/_published/{number:08d}.json", json.dumps(current))
        for table in current:
            kept = {place.split("/")[1] for place in (current[table], last.get(table)) if place}
            folder = f"{self.root}/{layer}/{table}"
            for name in self.files.names(folder):
                if name not in kept:
                    self.files.remove(f"{folder}/{name}")
