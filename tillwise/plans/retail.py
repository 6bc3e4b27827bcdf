"""The retail datasets of one snapshot, raw and cleaned, built lazily.

Nothing is cached here: each query declares its own plan and Spark reuses
identical exchanges inside it.  Callers that run many queries over one
snapshot can wrap the frames they reuse in ``operators.layout.persisted``.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean
from ..operators.joins import broadcast_if_small
from ..operators.layout import write_bucketed
from ..session import shared_path
from ..sources import testdata
from ..sources.scan import read_dataset
from ..sources.schemas import DATASETS

# Fixed arguments for the driver's data: the snapshot is dated on the last
# order date, and "recent" is measured from the same day.
AS_OF = "2001-08-01"
INGEST_DATE = "2001-08-01"


class Retail:
    """Raw and cleaned frames of one snapshot.  ``Retail.of`` returns one
    shared instance per (session, folder, dates), so the cleaned plans are
    built once and reused by every report (plans only; no data is cached)."""

    _shared: dict[tuple, "Retail"] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, as_of=AS_OF,
           ingest_date=INGEST_DATE) -> "Retail":
        key = (id(spark), sf_dir, str(as_of), str(ingest_date))
        r = cls._shared.get(key)
        if r is None or r.spark is not spark:
            r = cls._shared[key] = cls(spark, sf_dir, as_of, ingest_date)
        return r

    def __init__(self, spark: SparkSession, sf_dir: str, as_of=AS_OF,
                 ingest_date=INGEST_DATE, raw: dict[str, DataFrame] | None = None,
                 store_limit: int = 100_000):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.ingest_date = ingest_date
        self.store_limit = store_limit
        self._raw = dict(raw or {})

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = testdata.derive(self.spark, self.sf_dir, name)
        return self._raw[name]

    @cached_property
    def transactions(self) -> DataFrame:
        return clean.clean_transactions(self.raw("transactions"), self.ingest_date)

    @cached_property
    def recent_transactions(self) -> DataFrame:
        return clean.recent_transactions(self.raw("transactions"), self.ingest_date, self.as_of)

    @cached_property
    def lines(self) -> DataFrame:
        """Item lines whose prices are as delivered, for results that read none."""
        return clean.stamped_items(self.raw("items"), self.ingest_date)

    @cached_property
    def items(self) -> DataFrame:
        return clean.clean_items(self.raw("items"), self.ingest_date)

    @cached_property
    def stores(self) -> DataFrame:
        return clean.clean_stores(self.raw("stores"), self.ingest_date)

    @cached_property
    def customers(self) -> DataFrame:
        return clean.clean_customers(self.raw("customers"), self.recent_transactions,
                                     self.ingest_date)

    @cached_property
    def all_customers(self) -> DataFrame:
        """Customers whether or not they bought recently."""
        return clean.dated_customers(self.raw("customers"), self.ingest_date)

    @cached_property
    def products(self) -> DataFrame:
        return clean.clean_products(self.raw("products"), self.ingest_date)

    @cached_property
    def inventory(self) -> DataFrame:
        return clean.clean_inventory(self.raw("inventory"), self.ingest_date)

    @cached_property
    def promotions(self) -> DataFrame:
        return clean.clean_promotions(self.raw("promotions"), self.ingest_date)

    @cached_property
    def suppliers(self) -> DataFrame:
        return clean.clean_suppliers(self.raw("suppliers"), self.ingest_date)

    # ------------------------------------------------------------ other inputs

    @classmethod
    def from_landing(cls, spark: SparkSession, root: str, ingest_date=INGEST_DATE,
                     as_of=AS_OF, fmt: str = "csv", store_limit: int = 100_000) -> "Retail":
        """The eight dataset readers: each scans the snapshot delivered on
        ``ingest_date`` under ``root`` (declared schema) and is then cleaned
        by the same steps as any other input."""
        raw = {name: read_dataset(spark, root, name, ingest_date, fmt) for name in DATASETS}
        # stores is the one dimension joined everywhere: broadcast it when a
        # row-count check proves it small (AQE decides otherwise)
        raw["stores"] = broadcast_if_small(raw["stores"], store_limit)
        return cls(spark, root, as_of, ingest_date, raw=raw, store_limit=store_limit)

    _CLEANED = ("transactions", "items", "stores", "customers", "products",
                "inventory", "promotions", "suppliers")
    _FACTS = ("transactions", "items")

    def materialize(self, path: str | None = None) -> "Retail":
        """Write every cleaned dataset once as Parquet and return a Retail
        whose frames read those files.

        This cuts the lineage: reports run on the written tables, and an
        executor lost later costs a re-read, not a re-run of dedup and
        imputation.  The files go to the shared folder named by
        ``spark.checkpoint.dir``, a folder of their own per call, unless
        ``path`` (a new folder) is given.  Transactions and items are bucketed
        by ``transaction_id`` alike, so reports join them without a shuffle."""
        base = path or shared_path(self.spark, "tillwise-cleaned", uuid.uuid4().hex)
        out = Retail(self.spark, self.sf_dir, self.as_of, self.ingest_date, raw=self._raw,
                     store_limit=self.store_limit)
        for name in self._CLEANED:  # transactions first: what follows reads the written table
            target = f"{base}/{name}"
            source = out if name in ("customers", "recent_transactions") else self
            if name in self._FACTS:
                out.__dict__[name] = write_bucketed(getattr(source, name), target, "transaction_id")
            else:
                getattr(source, name).write.parquet(target)
                out.__dict__[name] = self.spark.read.parquet(target)
            if name == "transactions":
                out.__dict__["recent_transactions"] = clean.recent(
                    out.transactions, "transaction_date", self.as_of, 36)
            if name == "items":
                out.__dict__["lines"] = out.items
        out.__dict__["stores"] = broadcast_if_small(out.stores, self.store_limit)
        return out
