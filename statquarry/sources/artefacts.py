"""Results of a job published together: tables, text reports and models, of which a reader never sees a half.

Every publication writes its parts into a new folder and, when all are there, adds a manifest: one small file that names them
with their kinds, schemas and row counts, put in place by a rename.  A reader takes the newest manifest and only what it names;
a job that dies in between leaves files that no manifest mentions.  Earlier publications stay readable by their number.
Files are reached through the file system of the folder, so it may lie wherever Spark reads and writes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from statquarry.operators.boosting import TREE_ROWS, Boosted, Grid, Trial, add_trees, tree_rows
from statquarry.sources.tables import write_report

Part = DataFrame | Boosted | PipelineModel
MANIFEST = "manifest-{:08d}.json"
_GRID_ROWS = "feature int, low double, width double, bins array<int>"
_PARAMETERS = "start double, features string, trial string"


class Report:
    """Text blocks (columns ``metric``, ``block``) that are written as text."""

    def __init__(self, blocks: DataFrame):
        self.blocks = blocks


class Store:
    """Publications in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.jvm = spark._jvm
        self.files = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, place: str):
        return self.jvm.org.apache.hadoop.fs.Path(place)

    # ---- manifests ------------------------------------------------------------------------------------------------
    def versions(self) -> list[int]:
        """Numbers of the complete publications."""
        top = self._path(self.folder)
        if not self.files.exists(top):
            return []
        names = [s.getPath().getName() for s in self.files.listStatus(top)]
        return sorted(int(n[9:17]) for n in names if n.startswith("manifest-") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        known = self.versions()
        if not known or version is not None and version not in known:
            raise FileNotFoundError(f"no publication {'' if version is None else version} in {self.folder}")
        stream = self.files.open(self._path(f"{self.folder}/{MANIFEST.format(known[-1] if version is None else version)}"))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _add_manifest(self, body: dict) -> int:
        draft = self._path(f"{self.folder}/_draft-{uuid.uuid4().hex}")
        stream = self.files.create(draft, False)
        stream.write(bytearray(json.dumps(body, indent=1).encode()))
        stream.close()
        while True:
            version = (self.versions() or [0])[-1] + 1
            place = self._path(f"{self.folder}/{MANIFEST.format(version)}")
            # a rename does not replace a file that another job has put there meanwhile
            if not self.files.exists(place) and self.files.rename(draft, place):
                return version

    # ---- parts ------------------------------------------------------------------------------------------------------
    def publish(self, **parts: Part | Report) -> int:
        """Write all parts, then the manifest; returns the publication's number."""
        home = f"parts-{uuid.uuid4().hex}"
        return self._add_manifest({"parts": {name: self._write(f"{home}/{name}", part) for name, part in parts.items()}})

    def _write(self, place: str, part: Part | Report) -> dict:
        path = f"{self.folder}/{place}"
        if isinstance(part, DataFrame):
            part.write.parquet(path)
            written = self.spark.read.schema(part.schema).parquet(path)
            return {"kind": "table", "path": place, "rows": written.count(), "schema": part.schema.jsonValue()}
        if isinstance(part, Report):
            write_report(part.blocks, path)
            return {"kind": "report", "path": place}
        if isinstance(part, Boosted):
            grid, made = part.grid, self.spark.createDataFrame
            tables = {
                "trees": made(tree_rows([part]), TREE_ROWS),
                "grid": made([(f, float(a), float(w), b.tolist()) for f, (a, w, b) in enumerate(zip(grid.low, grid.width, grid.bins))], _GRID_ROWS),
                "parameters": made([(part.start, part.features, json.dumps(vars(part.trial)))], _PARAMETERS),
            }
            return {"kind": "boosted", "parts": {name: self._write(f"{place}/{name}", table) for name, table in tables.items()}}
        part.write().save(path)
        return {"kind": "pipeline", "path": place}

    def load(self, name: str, version: int | None = None):
        """A table or report (DataFrame), a pipeline or a model, as it was published."""
        parts = self.manifest(version)["parts"]
        if name not in parts:
            raise KeyError(name)
        return self._read(parts[name])

    def _read(self, entry: Mapping):
        if entry["kind"] == "table":
            found = self.spark.read.schema(StructType.fromJson(entry["schema"])).parquet(f"{self.folder}/{entry['path']}")
            if found.count() != entry["rows"]:
                raise OSError(f"{entry['path']} has not the rows its manifest names")
            return found
        if entry["kind"] == "report":
            return self.spark.read.text(f"{self.folder}/{entry['path']}")
        if entry["kind"] == "pipeline":
            return PipelineModel.load(f"{self.folder}/{entry['path']}")
        tables = {name: self._read(part).collect() for name, part in entry["parts"].items()}  # a model's own size
        lines = sorted(tables["grid"], key=lambda r: r["feature"])
        grid = Grid(*(np.array([r[c] for r in lines]) for c in ("low", "width", "bins")))
        held = tables["parameters"][0]
        model = Boosted(grid, Trial(**json.loads(held["trial"])), held["start"], [], held["features"])
        add_trees([model], tables["trees"])
        return model
