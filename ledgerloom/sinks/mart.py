"""The star schema as folders of Parquet files.

Facts are added in one folder per load, and daily sums are kept per month, one
version for each load that changed the month. Readers take published loads only
(see ``ledger``), so facts, their keys and their sums change together. The keys
of all facts lie in a table of their own, bucketed and sorted by key, so that a
load finds stored keys without moving them.

Customers, dates and rejects are added to one folder. Products lie in a fixed
number of parts by the hash of their key. A merge writes the parts it touches as
one new version beside those being read; readers take each part from the newest
version that has it, and only versions that Spark has marked complete. One
writer at a time.
"""

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import month_id
from ..operators.merge import anonymous_customer, key_part, upsert, with_surrogate_key
from ..schemas import OPTIONAL_TABLES, TABLES
from .ledger import Files, Ledger

# Large tables are laid out by load and month, or by month and load; the audit log by run.
FACTS, DAILY, INVOICES = "fact_transactions", "agg_daily_revenue", "agg_daily_invoices"
# Tables that hold one version of a month for each load that changed it.
BY_MONTH = [DAILY, INVOICES]
MONTHLY = [FACTS, *BY_MONTH]
SCHEMAS = TABLES | OPTIONAL_TABLES
REWRITTEN = ["dim_products"]
# Parts of a rewritten table: fixed, as stored rows are found by it.
PARTS = 32
KEYS = "_fact_keys"
# Readers trust the marker of a finished write, so it must not be switched off.
MARK = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}
# How large tables are packed; readers find out by themselves.
STORED = {"compression": "zstd"}


@dataclass(frozen=True)
class Mart:
    spark: SparkSession
    root: str
    buckets: int = 64

    def path(self, table):
        return f"{self.root.rstrip('/')}/{table}"

    @property
    def files(self):
        return Files(self.spark)

    @property
    def ledger(self):
        return Ledger(self.files, self.path("_loads"))

    def create(self):
        """Start an empty store with the anonymous customer; harmless later."""
        if not self._exists(f"{self.path('dim_customers')}/_SUCCESS"):
            seed = anonymous_customer(self.spark)
            self.append("dim_customers", seed.withColumn("created_at", F.current_timestamp()))
        return self

    # Reading ---------------------------------------------------------------

    def read(self, table) -> DataFrame:
        """The stored rows; an empty frame while nothing is stored."""
        if table in BY_MONTH:
            return self._read_folders(table, self._month_versions(table).values()).drop("load_no")
        if table in REWRITTEN:
            return self._read_parts(table)
        folder = self.path(table)
        if not self._exists(folder):
            return self._nothing(self._stored_schema(table)).drop("load_no")
        if table == FACTS:
            return self.facts_by_load().drop("load_no")
        return self.spark.read.schema(self._stored_schema(table)).parquet(folder)

    def facts_by_load(self):
        """The published facts, with the load that added them."""
        rows = self.spark.read.schema(self._stored_schema(FACTS)).parquet(self.path(FACTS))
        return rows.filter(F.col("load_no") <= self.ledger.published())

    def _nothing(self, columns):
        """No rows, behind a filter the optimizer sees through: joins with this cost nothing."""
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in columns]
        return self.spark.range(1).select(*nothing).filter(F.lit(False))

    def _read_folders(self, table, folders):
        """Rows of some folders below a table's own, with the columns the folder names give."""
        if not folders:
            return self._nothing(self._stored_schema(table))
        reader = self.spark.read.schema(self._stored_schema(table))
        return reader.option("basePath", self.path(table)).parquet(*folders)

    @staticmethod
    def _stored_schema(table):
        """The table's columns and, if it is laid out by month, the month and the load."""
        extra = ["month_id", "load_no"] if table in MONTHLY else []
        return T.StructType(SCHEMAS[table].fields + [T.StructField(c, T.IntegerType()) for c in extra])

    def _loads_of_months(self, table):
        """(month, its folder, the loads that wrote a version of it, rising)."""
        for name in self.files.names(self.path(table)):
            if name.startswith("month_id="):
                folder = f"{self.path(table)}/{name}"
                loads = [n.split("=")[1] for n in self.files.names(folder) if n.startswith("load_no=")]
                yield int(name.split("=")[1]), folder, sorted(map(int, loads))

    def _month_versions(self, table):
        """Folder of the newest published version of each month."""
        last, found = self.ledger.published(), {}
        for month, folder, loads in self._loads_of_months(table):
            newest = max((n for n in loads if n <= last), default=None)
            if newest is not None:
                found[month] = f"{folder}/load_no={newest}"
        return found

    def daily_sums(self, months, table=DAILY):
        """Stored sums of some months; the others are not opened."""
        versions = self._month_versions(table)
        chosen = [versions[m] for m in months if m in versions]
        return self._read_folders(table, chosen).drop("load_no", "month_id")

    def _read_parts(self, table, parts=None):
        """Rows of a rewritten table, or of some of its parts; the others are not opened."""
        whole, found = self._newest_parts(table)
        if whole:
            return self.spark.read.schema(self._stored_schema(table)).parquet(whole)
        folders = [folder for part, folder in sorted(found.items()) if parts is None or part in parts]
        if not folders:
            return self._nothing(self._stored_schema(table))
        schema = T.StructType(SCHEMAS[table].fields + [T.StructField(c, T.IntegerType()) for c in ("version", "part")])
        rows = self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*folders)
        return rows.drop("version", "part")

    def _newest_parts(self, table):
        """(folder, {}) if the newest version is a whole one, else (None, folder of each part).

        The first merge over a whole version writes every part that has rows,
        so nothing older than that merge is needed.
        """
        found = {}
        for version in reversed(self._versions(table)):
            parts = self._parts_of(version)
            if parts is None:
                return (None, found) if found else (version, {})
            for part, folder in parts.items():
                found.setdefault(part, folder)
        return None, found

    def _parts_of(self, version):
        """Folders of the parts in a version; None if it is a whole table."""
        names = self.files.names(version)
        if any(name.endswith(".parquet") for name in names):
            return None
        return {int(n.split("=")[1]): f"{version}/{n}" for n in names if n.startswith("part=")}

    def tables(self):
        return {name: self.read(name) for name in TABLES}

    def register(self, prefix=""):
        """Make the tables temporary views, for questions in SQL."""
        for name, rows in self.tables().items():
            rows.createOrReplaceTempView(prefix + name)

    def highest(self, table, column):
        """Largest number in an append-only table, 0 if there is none.

        A session of its own turns on the push-down that answers this from
        the Parquet footers, without reading the column.
        """
        if not self._exists(self.path(table)):
            return 0
        probe = self.spark.newSession()
        probe.conf.set("spark.sql.sources.useV1SourceList", "")
        probe.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        stored = probe.read.schema(self._stored_schema(table)).parquet(self.path(table))
        return stored.agg(F.max(column)).first()[0] or 0

    # Writing ---------------------------------------------------------------

    def append(self, table, rows, number=None):
        """Add rows; ``number`` names a column of ids to give them above the stored ones.

        Ids are given behind the last shuffle, in the task that writes them, so
        that a repeated task cannot give them to other rows.
        """
        highest = self.highest(table, number) if number else None
        if number:
            rows = rows.withColumn(number, F.lit(None).cast("long"))
        self._writer(table, self._shaped(table, rows), number, highest).mode("append").parquet(self.path(table))

    def replace(self, table, rows):
        """Write all rows of a rewritten table as its next version.

        What was read before it stays for whoever is still reading it.
        """
        versions = self._versions(table)
        self._shaped(table, rows).write.options(**MARK).mode("overwrite").parquet(self._next_version(table, versions))
        whole = [i for i, version in enumerate(versions) if self._parts_of(version) is None]
        for outdated in versions[: max(whole, default=0)]:
            self.remove(outdated)

    def merge(self, table, fresh, keys, update):
        """Update or insert ``fresh`` in a rewritten table (see ``merge.upsert``).

        Only the parts that ``fresh`` falls into are read, joined and written;
        they become visible together. Nothing is written if there are none.
        """
        part = key_part(keys, PARTS)
        touched = {row.part for row in fresh.select(part.alias("part")).distinct().collect()}  # at most PARTS
        if not touched:
            return
        stored = self._read_parts(table, touched)
        versions = self._versions(table)
        merged = self._shaped(table, upsert(stored, fresh, keys, update)).withColumn("part", part)
        # Gathers each part in a task, unless it is large.
        writer = merged.hint("rebalance", "part").write.options(**MARK).partitionBy("part")
        writer.mode("overwrite").parquet(self._next_version(table, versions))
        self._forget_parts(table)

    def _next_version(self, table, versions):
        """The folder above the last complete version; what a lost run left there is overwritten."""
        number = self._version_number(versions[-1]) + 1 if versions else 1
        return f"{self.path(table)}/version={number:09d}"

    def _forget_parts(self, table):
        """Keep the newest two versions of each part: somebody may still read the older one."""
        seen, versions = {}, self._versions(table)
        for i in reversed(range(len(versions))):
            version, parts = versions[i], self._parts_of(versions[i])
            if parts is None:
                # Two merges above a whole version: nobody needs it, nor what is older (which goes first).
                for outdated in versions[: i + 1] if i < len(versions) - 2 else []:
                    self.remove(outdated)
                return
            outdated = [folder for part, folder in parts.items() if seen.get(part, 0) > 1]
            # A version without parts goes whole.
            for folder in [version] if len(outdated) == len(parts) else outdated:
                self.remove(folder)
            for part in parts:
                seen[part] = seen.get(part, 0) + 1

    def replace_run(self, table, column, value, rows):
        """Overwrite the folder of one run, also when it has no rows left."""
        folder = f"{self.path(table)}/{column}={value}"
        self._shaped(table, rows).drop(column).write.mode("overwrite").parquet(folder)

    # Loads -----------------------------------------------------------------

    def begin_load(self):
        return self.ledger.begin(self._discard)

    def publish_load(self, number):
        """Make all that load ``number`` has written visible at once."""
        self.ledger.publish(number)
        self._forget_versions()

    def _discard(self, number):
        """Remove what a lost load has written."""
        self.remove(f"{self.path(FACTS)}/load_no={number}")
        self.remove(f"{self.path(KEYS)}/load_no={number}")
        for table in BY_MONTH:
            for _, folder, loads in self._loads_of_months(table):
                if number in loads:
                    self.remove(f"{folder}/load_no={number}")

    def _forget_versions(self):
        """Keep the newest two versions of each month: somebody may still read the older one."""
        last = self.ledger.published()
        for table in BY_MONTH:
            for _, folder, loads in self._loads_of_months(table):
                for old in [n for n in loads if n <= last][:-2]:
                    self.remove(f"{folder}/load_no={old}")

    def add_facts(self, rows, number, made=None):
        """Write the facts of a load, with ids above the stored ones.

        ``made`` makes them of ``rows`` that have a ``month_id``, once these are laid out by it.
        """
        highest = self.highest(FACTS, "transaction_id")
        facts = rows if made is None else made(rows.hint("rebalance", "month_id"))
        facts = facts.withColumn("transaction_id", F.lit(None).cast("long"))
        writer = self._writer(FACTS, self._shaped(FACTS, facts), "transaction_id", highest, gathered=made is not None)
        writer.mode("overwrite").parquet(f"{self.path(FACTS)}/load_no={number}")

    def write_sums(self, rows, number, table=DAILY, gathered=False):
        """Write the months in ``rows`` as their versions of a load; all of a month's rows must be there.

        ``gathered``: the rows of a month are in few tasks already.
        """
        rows = self._shaped(table, rows).withColumn("load_no", F.lit(number))
        writer = self._writer(table, rows, parts=["month_id", "load_no"], gathered=gathered)
        writer.mode("append").parquet(self.path(table))

    # What runs did --------------------------------------------------------

    def log_run(self, entries, run_date, number):
        """Keep the counts (stage, name, n) of a run."""
        rows = self.spark.createDataFrame(entries, "stage string, name string, n long")
        rows = rows.select(F.lit(number).alias("load_no"), F.lit(run_date).cast("date").alias("run_date"), "*")
        rows.coalesce(1).write.mode("append").parquet(self.path("_run_log"))

    def run_log(self):
        """(load_no, run_date, stage, name, n) of all published runs."""
        schema = "load_no int, run_date date, stage string, name string, n long"
        if not self._exists(self.path("_run_log")):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path("_run_log"))

    # Keys of all facts -----------------------------------------------------

    def key_table(self, columns):
        """Name of the catalog's table over the stored keys, with the folders of all loads."""
        path = self.path(KEYS)
        others = [n for n in self.files.names(self.root) if n.startswith(f"{KEYS}.")]
        shape = f"{KEYS}.{self.buckets}.{len(columns)}"
        if others and others != [shape]:
            raise ValueError(f"the store's keys were written as {others}, not as {shape}")
        self.files.touch(self.path(shape))
        self.files.make(path)
        name = f"ledgerloom_keys_{hashlib.md5(path.encode()).hexdigest()}"
        kinds = ", ".join(f"{c} string" for c in columns)
        where = path.replace("'", "\\'")
        packed = ", ".join(f"{option} '{value}'" for option, value in STORED.items())
        # Made anew each time: the folders of a lost load may be gone. Dropping it leaves the files.
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(
            f"CREATE TABLE {name} ({kinds}, load_no int) USING parquet OPTIONS ({packed}) PARTITIONED BY (load_no) "
            f"CLUSTERED BY ({', '.join(columns)}) SORTED BY ({', '.join(columns)}) "
            f"INTO {self.buckets} BUCKETS LOCATION '{where}'"
        )
        self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return name

    def stored_keys(self, columns):
        """Keys of all published facts, bucketed and, within a file, sorted by ``columns``."""
        keys = self.spark.table(self.key_table(columns))
        return keys.filter(F.col("load_no") <= self.ledger.published()).select(*columns)

    def has_keys(self):
        """Whether a published load has written keys."""
        last = self.ledger.published()
        loads = [name.split("=")[1] for name in self.files.names(self.path(KEYS)) if name.startswith("load_no=")]
        return any(int(load) <= last for load in loads)

    def add_keys(self, rows, columns, number, counted=None):
        """Write the keys of a load's facts, one file for each bucket that has any.

        Returns how many of the rows that are ``counted`` have a key that is there twice: equal
        keys meet in their bucket, so no row is moved for this but its key, which is moved anyway.
        """
        counted = F.lit(True) if counted is None else counted
        keys = rows.select(*columns, counted.alias("_counted")).repartition(self.buckets, *columns)
        twice = F.count("*").over(Window.partitionBy(*columns)) > 1
        found = Observation()
        keys = keys.withColumn("_twice", twice).observe(found, F.count_if(F.col("_twice") & F.col("_counted")).alias("n"))
        keys.select(*columns, F.lit(number).alias("load_no")).write.mode("append").insertInto(self.key_table(columns))
        return found.get["n"]

    def remove(self, folder):
        self.files.remove(folder)

    def _shaped(self, table, rows):
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[table]])

    def _writer(self, table, rows, number=None, highest=None, parts=("month_id",), gathered=False):
        if table in MONTHLY:
            # Rebalancing gathers each month and splits months that are large.
            rows = rows.withColumn("month_id", month_id(F.col("date_id")))
            rows = rows if gathered else rows.hint("rebalance", "month_id")
            rows = rows.sortWithinPartitions("month_id", "date_id")
            if number:
                rows = with_surrogate_key(rows, number, highest)
            return rows.write.options(**STORED).partitionBy(*parts)
        if table == "reject_log":
            return rows.write.options(**STORED).partitionBy("pipeline_run_date")
        return rows.write.options(**MARK)

    # Files -----------------------------------------------------------------

    def _exists(self, folder):
        return self.files.exists(folder)

    def _versions(self, table):
        """Folders of the complete versions, oldest first."""
        versions = [f"{self.path(table)}/{name}" for name in self.files.names(self.path(table))]
        return [v for v in versions if self._exists(f"{v}/_SUCCESS")]

    @staticmethod
    def _version_number(folder):
        return int(folder.rsplit("=", 1)[1])
