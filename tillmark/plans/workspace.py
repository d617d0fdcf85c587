"""All tables of one data set, wired together.

Every table is a frame built from the ones before it; tables that rank rows or pair products store intermediate ones
while they are being defined.  With a target folder or database each table is written
once and read back by the tables above it, which is how a full refresh runs on a cluster: no table is computed twice,
and a lost executor costs the tasks of one table.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Collection, Mapping
from functools import cached_property, partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillmark.operators.durable import checkpointed, scratch
from tillmark.plans import facts, marts, quality, recommend, segments, staging
from tillmark.sources import readers, schemas, sinks, testtables

MODEL_OUTPUTS = ("customer_segments", "customer_recommendations")
REFRESH_ORDER = (
    "dim_categories", "dim_cities", "dim_countries",
    "st_customers", "st_employees", "st_products", "st_sales",
    "fct_sales_summary", "fct_customer_behavior", "fct_employee_performance",
    "customer_lifetime_value", "mart_customer_behavior", "mart_employee_performance", "mart_sales_summary",
    "mart_recommend",
    *MODEL_OUTPUTS,
)

# Tables that are stored by month: sales reports and upserts touch only the months they are about.
# Tables whose rows an upsert looks up.
FOUND_BY = dict.fromkeys(("st_sales", "fct_sales_summary"), ("sales_id",))
STORED_BY = dict.fromkeys(("st_sales", "fct_sales_summary", "mart_sales_summary"), ("year", "month"))

# Tables that are stored with their load time, and the column that holds it.
LOAD_TIME = {
    **dict.fromkeys(("st_customers", "st_employees", "st_products"), "dbt_loaded_at"),
    **dict.fromkeys(("fct_sales_summary", "fct_customer_behavior", "fct_employee_performance"), "dbt_loaded_at"),
    **dict.fromkeys(("mart_employee_performance", "mart_sales_summary", "mart_recommend"), "dbt_loaded_at"),
    **dict.fromkeys(MODEL_OUTPUTS, "model_generated_at"),
}


class Workspace:
    """``sources`` maps the raw and lookup tables (sales, products, customers, employees, categories, cities,
    countries) to frames, or to functions that give them."""

    def __init__(
        self,
        sources: Mapping[str, DataFrame | Callable[[], DataFrame]],
        as_of: datetime.date | None = None,
        settings: recommend.ModelSettings = recommend.DEFAULTS,
    ):
        self._sources = dict(sources)
        self._stored: dict[str, DataFrame] = {}
        # What the last refresh measured while it wrote: table -> measure -> value.
        self.measured: dict[str, dict] = {}
        self.as_of = as_of
        self.settings = settings

    @classmethod
    def of_test_tables(cls, spark: SparkSession, folder: str) -> Workspace:
        names = ("sales", "products", "customers", "employees", "categories", "cities", "countries")
        sources = {name: partial(getattr(testtables, name), spark, folder) for name in names}
        return cls(sources, as_of=datetime.date(2001, 12, 31))

    def source(self, name: str) -> DataFrame:
        if callable(self._sources[name]):
            self._sources[name] = self._sources[name]()
        return self._sources[name]

    def table(self, name: str) -> DataFrame:
        """The stored table where it has been written, the lazy frame otherwise."""
        if name in self._stored:
            return self._stored[name]
        return getattr(self, name)

    def refresh(
        self,
        target: str,
        tables: tuple[str, ...] = REFRESH_ORDER,
        most: Mapping[tuple[str, str], float] | None = None,
    ) -> dict[str, DataFrame]:
        """Rebuild tables in order below ``target``: a folder (anything with a slash) or a database.

        Each write gathers the measures of its table (``quality.measures``) into ``measured``, without another scan;
        with limits (``most``, such as ``quality.MOST``) a table beyond one stops the refresh.  Intermediate tables are
        removed at the end, so frames that were built from them are forgotten: a table asked for later is the stored
        one, or is built anew from stored ones.
        """
        try:
            with scratch(self.source("sales").sparkSession):
                self._store(target, tables, most)
        finally:
            self._forget()
        return dict(self._stored)

    def publish(
        self,
        target: str,
        tables: tuple[str, ...] = REFRESH_ORDER,
        most: Mapping[tuple[str, str], float] | None = None,
    ) -> dict[str, DataFrame]:
        """A refresh into a version of its own below the folder ``target``, which becomes visible as a whole at its end.

        ``sinks.published`` reads the last version that got that far: where a table fails, or is beyond a limit, readers
        and this workspace keep the tables they had.  ``sinks.remove_versions`` removes old ones.
        """
        spark = self.source("sales").sparkSession
        version = sinks.new_version(spark, target)
        before = (self._stored, self.measured)
        self._stored, self.measured = {}, {}
        try:
            stored = self.refresh(version, tables, most)
            sinks.publish(spark, version)
        except BaseException:
            self._stored, self.measured = before
            self._forget()
            raise
        return stored

    def _forget(self, but: Collection[str] = ()) -> None:
        for name in [n for n in self.__dict__ if n not in but and isinstance(getattr(type(self), n, None), cached_property)]:
            del self.__dict__[name]

    def _store(self, target: str, tables: tuple[str, ...], most: Mapping[tuple[str, str], float] | None) -> None:
        for name in tables:
            place = f"{target.rstrip('/')}/{name}" if "/" in target else f"{target}.{name}"
            before, seen = set(self.__dict__), Observation()
            # Intermediate tables of a table go, with the frames that read them, as soon as it is stored.
            with scratch(self.source("sales").sparkSession):
                frame = self._with_load_time(name, getattr(self, name))
                measures = [column.alias(label) for label, column in quality.measures(name).items()]
                if name in MODEL_OUTPUTS:
                    stored = sinks.drop_and_write(frame, place, seen, *measures)
                else:
                    by, found_by = STORED_BY.get(name, ()), FOUND_BY.get(name, ())
                    stored = sinks.write_table(frame, place, by, seen, *measures, found_by=found_by)
            self._forget(before)
            self.measured[name] = seen.get
            if most is not None:
                quality.require_limits(name, self.measured[name], most)
            self._stored[name] = stored

    def upsert_sales(self, target: str, batch: DataFrame) -> dict[str, DataFrame]:
        """Bring raw sale lines into the stored tables below the folder ``target``.

        A line replaces those of its id, wherever they are stored.  Where the batch repeats an id, or a dimension row
        that occurs twice repeats a line, all of its rows are taken, as a refresh takes them.  The dimensions are the
        stored ones.  Facts and marts that are stored follow: customers, employees and months that
        a new line has, or a replaced one had, are computed again, and ranks and scores over all of them are given
        anew.  Recommendations and models are left as they are until the next refresh.
        """
        folder = target.rstrip("/")
        with scratch(batch.sparkSession):
            lines = checkpointed(staging.st_sales(batch, self.source("products")))
            by = STORED_BY["st_sales"]
            owners = ("customer_id", "salesperson_id", *by)
            replaced = batch.sparkSession.read.parquet(f"{folder}/st_sales").select("sales_id", *owners)
            replaced = facts.only(sinks.near_keys(replaced, lines, "sales_id"), lines, "sales_id")
            touched = checkpointed(replaced.select(*owners).unionByName(lines.select(*owners)).distinct())
            self._stored["st_sales"] = sinks.upsert_partitions(f"{folder}/st_sales", lines, ("sales_id",), by, unique=False)
            fact = facts.fct_sales_summary(
                lines, self.table("st_products"), self.table("st_customers"), self.table("st_employees")
            )
            with scratch(batch.sparkSession):
                fact = checkpointed(staging.with_load_time(fact, LOAD_TIME["fct_sales_summary"]))
                self._stored["fct_sales_summary"] = sinks.upsert_partitions(
                    f"{folder}/fct_sales_summary", fact, ("sales_id",), by, unique=False
                )
            self._follow(folder, touched)
        self._forget()
        return dict(self._stored)

    def _follow(self, folder: str, touched: DataFrame) -> None:
        """Bring the stored facts and marts behind the sales up to date."""
        customers = checkpointed(touched.select("customer_id").distinct())
        employees = checkpointed(touched.select(F.col("salesperson_id").alias("employee_id")).distinct())
        months = checkpointed(touched.select(*STORED_BY["mart_sales_summary"]).distinct())
        sales = self._stored["st_sales"]

        def behavior() -> DataFrame:
            fresh = facts.fct_customer_behavior(facts.only(sales, customers, "customer_id"))
            fresh = staging.with_load_time(fresh, LOAD_TIME["fct_customer_behavior"])
            return facts.updated_customer_behavior(self._stored["fct_customer_behavior"], fresh, customers)

        def performance() -> DataFrame:
            sold = facts.only(sales, employees.withColumnRenamed("employee_id", "salesperson_id"), "salesperson_id")
            staff = facts.only(self.table("st_employees"), employees, "employee_id")
            fresh = staging.with_load_time(facts.fct_employee_performance(staff, sold), LOAD_TIME["fct_employee_performance"])
            old = facts.only(self._stored["fct_employee_performance"], employees, "employee_id", "left_anti")
            return old.unionByName(fresh)

        def lifetime_value() -> DataFrame:
            old = self._stored["customer_lifetime_value"]
            return marts.updated_lifetime_value(old, sales, self.table("st_customers"), customers)

        def customer_mart() -> DataFrame:
            return marts.mart_customer_behavior(self.table("fct_customer_behavior"), self.table("st_customers"))

        def employee_mart() -> DataFrame:
            rows = self.table("fct_employee_performance").drop(LOAD_TIME["fct_employee_performance"])
            return self._with_load_time("mart_employee_performance", marts.mart_employee_performance(rows))

        def sales_mart() -> DataFrame:
            fact = self._stored["fct_sales_summary"].join(months, list(STORED_BY["mart_sales_summary"]), "left_semi")
            totals = marts.sales_totals(fact, self.table("st_products"))
            return self._with_load_time("mart_sales_summary", marts.mart_sales_summary(totals))

        def own(name: str, rows: DataFrame) -> DataFrame:
            """Stored aside, as it is made from the table that it replaces."""
            return sinks.write_table(checkpointed(rows), f"{folder}/{name}")

        def whole(name: str, rows: DataFrame) -> DataFrame:
            return sinks.write_table(rows, f"{folder}/{name}")

        def by_month(name: str, rows: DataFrame) -> DataFrame:
            return sinks.overwrite_partitions(f"{folder}/{name}", rows, months, STORED_BY[name])

        for name, rows, store in (
            ("fct_customer_behavior", behavior, own),
            ("fct_employee_performance", performance, own),
            ("customer_lifetime_value", lifetime_value, own),
            ("mart_customer_behavior", customer_mart, whole),
            ("mart_employee_performance", employee_mart, whole),
            ("mart_sales_summary", sales_mart, by_month),
        ):
            if name in self._stored:
                with scratch(sales.sparkSession):
                    self._stored[name] = store(name, rows())

    @staticmethod
    def _with_load_time(name: str, rows: DataFrame) -> DataFrame:
        return staging.with_load_time(rows, LOAD_TIME[name]) if name in LOAD_TIME else rows

    # --- lookups and staging -----------------------------------------------------------------------------------------

    @cached_property
    def dim_categories(self) -> DataFrame:
        return staging.dim_categories(self.source("categories"))

    @cached_property
    def dim_cities(self) -> DataFrame:
        return staging.dim_cities(self.source("cities"))

    @cached_property
    def dim_countries(self) -> DataFrame:
        return staging.dim_countries(self.source("countries"))

    @cached_property
    def st_customers(self) -> DataFrame:
        return staging.st_customers(self.source("customers"), self.table("dim_cities"), self.table("dim_countries"))

    @cached_property
    def st_employees(self) -> DataFrame:
        return staging.st_employees(
            self.source("employees"), self.table("dim_cities"), self.table("dim_countries"), self.as_of
        )

    @cached_property
    def st_products(self) -> DataFrame:
        return staging.st_products(self.source("products"), self.table("dim_categories"))

    @cached_property
    def st_sales(self) -> DataFrame:
        return staging.st_sales(self.source("sales"), self.source("products"))

    # --- facts -------------------------------------------------------------------------------------------------------

    @cached_property
    def fct_sales_summary(self) -> DataFrame:
        return facts.fct_sales_summary(
            self.table("st_sales"), self.table("st_products"), self.table("st_customers"), self.table("st_employees")
        )

    @cached_property
    def fct_customer_behavior(self) -> DataFrame:
        return facts.fct_customer_behavior(self.table("st_sales"))

    @cached_property
    def fct_employee_performance(self) -> DataFrame:
        return facts.fct_employee_performance(self.table("st_employees"), self.table("st_sales"))

    # --- marts -------------------------------------------------------------------------------------------------------

    @cached_property
    def customer_lifetime_value(self) -> DataFrame:
        return marts.customer_lifetime_value(self.table("st_sales"), self.table("st_customers"))

    @cached_property
    def mart_customer_behavior(self) -> DataFrame:
        return marts.mart_customer_behavior(self.table("fct_customer_behavior"), self.table("st_customers"))

    @cached_property
    def mart_employee_performance(self) -> DataFrame:
        return marts.mart_employee_performance(self.table("fct_employee_performance"))

    @cached_property
    def sales_totals(self) -> DataFrame:
        """The sales mart without ranks, for the reports that use none."""
        if "mart_sales_summary" in self._stored:
            return self._stored["mart_sales_summary"]
        return marts.sales_totals(self.table("fct_sales_summary"), self.table("st_products"))

    def hot_selling(self, top: int) -> DataFrame:
        """Rows with a hot-seller rank within ``top``: of the stored mart, else found without ranking the rest."""
        if "mart_sales_summary" in self._stored:
            return self._stored["mart_sales_summary"].where(F.col("monthly_hot_selling_product_rank") <= top)
        return marts.hot_selling(self.sales_totals, top)

    def top_lifetime_value(self, top: int) -> DataFrame:
        """So many customers who spent most; read from the stored mart where there is one."""
        if "customer_lifetime_value" in self._stored:
            return self._stored["customer_lifetime_value"]
        return marts.customer_lifetime_value(self.table("st_sales"), self.table("st_customers"), top)

    def top_employees(self, top: int) -> DataFrame:
        if "mart_employee_performance" in self._stored:
            return self._stored["mart_employee_performance"]
        return marts.top_employees(self.table("fct_employee_performance"), top)

    @cached_property
    def mart_sales_summary(self) -> DataFrame:
        return marts.mart_sales_summary(self.sales_totals)

    @cached_property
    def mart_recommend(self) -> DataFrame:
        return marts.mart_recommend(self.table("st_sales"), self.table("st_products"))

    # --- customer models ---------------------------------------------------------------------------------------------

    @cached_property
    def product_labels(self) -> DataFrame:
        """Without a product table: no row; without categories: no category name."""
        if "products" not in self._sources:
            return readers.empty(self.source("sales").sparkSession, schemas.PRODUCT_LABELS)
        return readers.product_labels(
            self.source("products"), self.source("categories") if "categories" in self._sources else None
        )

    @cached_property
    def customer_labels(self) -> DataFrame:
        """Without a customer table: no row."""
        if "customers" not in self._sources:
            return readers.empty(self.source("sales").sparkSession, schemas.CUSTOMER_LABELS)
        return readers.customer_labels(self.source("customers"))

    @cached_property
    def model_sales(self) -> DataFrame:
        """Sale lines, repaired: the input of the customer models.

        The curated lines are read where they can be built or are stored, the raw ones where the plan of the curated
        ones cannot be analysed (a column or table is missing).
        """
        try:
            lines = readers.sales_lines(self.table("st_sales"))
        except (AnalysisException, KeyError):
            lines = self.source("sales").select(*readers.SALES_LINE_COLUMNS)
        return segments.repaired_sales(lines, self.product_labels)

    @cached_property
    def customer_segments(self) -> DataFrame:
        return segments.rfm_segments(self.model_sales)

    @cached_property
    def heuristic_recommendations(self) -> DataFrame:
        return recommend.heuristic_recommendations(
            self.model_sales, self.product_labels, self.customer_labels, self.settings
        )

    @cached_property
    def als_recommendations(self) -> DataFrame:
        ratings = checkpointed(recommend.als_ratings(self.model_sales))
        return recommend.als_recommendations(
            ratings, self.product_labels, self.customer_labels, self.settings
        )

    @property
    def customer_recommendations(self) -> DataFrame:
        """Runs the gate and, behind it, the fit; a product table without rows stops it."""
        products = readers.require_rows(self.product_labels, "products")
        return recommend.recommendations(self.model_sales, products, self.customer_labels, self.settings)
