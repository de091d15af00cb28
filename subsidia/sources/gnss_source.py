"""Daily GNSS solutions as a data source of its own: ``spark.read.format("gnss_daily").load(folder)``.

Each station's file is a partition. Conditions on the station leave out files, by their names, before anything is opened;
conditions on the date leave out lines before they are parsed. Spark applies all conditions again, so they only save work.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds

# Where the two published formats have the station's figures, and how many fields a line has at least.
FIELDS = ("east", "north", "up", "sig_e", "sig_n", "sig_u", "corr_en", "corr_eu", "corr_nu")
LAYOUTS = {"tenv3": (20, ((7, 8), (9, 10), (11, 12), (14,), (15,), (16,), (17,), (18,), (19,))), "series": (17, tuple((i,) for i in range(1, 10)))}
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


class GnssDaily(ds.DataSource):
    """Options: ``source`` (tenv3 or series) and the folder or file as path."""

    @classmethod
    def name(cls) -> str:
        return "gnss_daily"

    def schema(self) -> str:
        return "source string, station string, obs_date date, " + ", ".join(f"{f} double" for f in FIELDS)

    def reader(self, schema) -> "GnssReader":
        return GnssReader(self.options["path"], self.options.get("source", "tenv3"))


class GnssReader(ds.DataSourceReader):
    def __init__(self, path: str, source: str):
        if source not in LAYOUTS:
            raise ValueError(f"no such format of daily solutions: {source}")
        self.path, self.source = path, source
        self.stations: set[str] | None = None
        self.first, self.last = dt.date.min, dt.date.max

    def pushFilters(self, filters):
        """Narrows stations and dates; every filter goes back, to be applied to the rows too."""
        for f in filters:
            column = getattr(f, "attribute", None)
            if column == ("station",) and isinstance(f, (ds.EqualTo, ds.In)):
                named = {f.value} if isinstance(f, ds.EqualTo) else set(f.value)
                self.stations = named if self.stations is None else self.stations & named
            elif column == ("obs_date",) and isinstance(getattr(f, "value", None), dt.date):
                if isinstance(f, (ds.EqualTo, ds.GreaterThan, ds.GreaterThanOrEqual)):
                    self.first = max(self.first, f.value)
                if isinstance(f, (ds.EqualTo, ds.LessThan, ds.LessThanOrEqual)):
                    self.last = min(self.last, f.value)
            yield f

    def partitions(self):
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path}")
        found = [store.get_file_info(at)]
        if found[0].type == fs.FileType.Directory:
            found = store.get_file_info(fs.FileSelector(at))
        files = sorted(i.path for i in found if i.type == fs.FileType.File and not i.base_name.startswith(("_", ".")))
        return [ds.InputPartition(f) for f in files if self.stations is None or station_of(f) in self.stations]

    def read(self, partition):
        import pyarrow as pa
        from pyarrow import fs

        if partition is None:  # what Spark makes of no partitions
            return
        store, _ = fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path}")
        with store.open_input_stream(partition.value) as file:
            lines = file.read().decode().splitlines()[1:]  # a station's file is small; its first line is a header
        least, places = LAYOUTS[self.source]
        name, rows = station_of(partition.value), []
        for line in lines:
            c = line.split()
            if len(c) >= least:
                day = date_of(c[1]) if self.source == "tenv3" else day_of(c[11:14])
                if day is None or self.first <= day <= self.last:
                    rows.append((self.source, c[0] if self.source == "tenv3" else name, day, *[total(c[i] for i in at) for at in places]))
        kinds = [pa.string(), pa.string(), pa.date32(), *[pa.float64()] * len(FIELDS)]
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["source", "station", "obs_date", *FIELDS])


def station_of(path: str) -> str:
    return path.rsplit("/", 1)[-1].split(".")[0].upper()


def date_of(text: str) -> dt.date | None:
    """The date of 21JAN05; NULL where it is none."""
    try:
        return dt.date(2000 + int(text[:2]), MONTHS.index(text[2:5].lower()) + 1, int(text[5:]))
    except ValueError:
        return None


def day_of(parts: list[str]) -> dt.date | None:
    try:
        return dt.date(*(int(float(p)) for p in parts))
    except ValueError:
        return None


def total(parts) -> float | None:
    try:
        return sum(map(float, parts))
    except ValueError:
        return None


def gnss_daily(spark: SparkSession, folder: str, source: str = "tenv3") -> DataFrame:
    """The registered source over a folder, with conditions pushed down."""
    spark.dataSource.register(GnssDaily)
    spark.conf.set(PUSHDOWN, "true")
    return spark.read.format("gnss_daily").option("source", source).load(folder)
