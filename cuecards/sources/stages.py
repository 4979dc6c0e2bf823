"""Stage tables (S9) and resumable jobs."""

from __future__ import annotations

import hashlib
import json
import pickle
import re
import sys
from collections.abc import Iterator
from pathlib import Path

from pyspark.serializers import CloudPickleSerializer
from pyspark.sql import DataFrame

from cuecards.session import checkpoint_dir

#: Settings that change what a query computes.
SETTINGS = ["spark.sql.ansi.enabled", "spark.sql.caseSensitive", "spark.sql.session.timeZone"]


def code_version() -> str:
    """Hash of this package's own sources: a table that other code wrote is not reused."""
    top = Path(__file__).resolve().parent.parent
    h = hashlib.sha1()
    for p in sorted(top.rglob("*.py")):
        if "llm" not in p.relative_to(top).parts:
            h.update(p.read_bytes())
    return h.hexdigest()


def _seq(s) -> Iterator:
    return (s.apply(i) for i in range(s.size()))


def _nodes(plan) -> Iterator:
    """The nodes of a logical plan in a fixed order, subqueries included."""
    yield plan
    for child in _seq(plan.subqueries()):
        yield from _nodes(child)
    for child in _seq(plan.children()):
        yield from _nodes(child)


def _expressions(node) -> Iterator:
    todo = list(_seq(node.expressions()))
    while todo:
        e = todo.pop()
        yield e
        todo += _seq(e.children())


def _leaf_identity(node, spark) -> str:
    """What a leaf reads: the files of a relation with sizes and times, the rows
    of a literal table.  Other leaves (rows handed over by the driver, RDDs,
    foreign tables) have no identity."""
    kind = node.getClass().getSimpleName()
    if kind == "LogicalRelation" and node.relation().getClass().getSimpleName() == "HadoopFsRelation":
        relation = node.relation()
        files = [f"{f}|{size}|{time}" for f, size, time in _file_states(spark, relation.location().inputFiles())]
        return "\n".join([relation.fileFormat().getClass().getName(), relation.schema().json(), relation.options().toString(), *files])
    if kind == "LocalRelation":
        return node.data().mkString("\n")
    if kind in ("Range", "OneRowRelation"):
        return ""  # the plan's text says all
    raise ValueError(f"the input {kind} has no identity: write it first, or pass identity=")


def _function_identity(e) -> str | None:
    """The code of a user function: what Spark ships of it and the source of
    its module (a function of an importable module is shipped by name)."""
    kind = e.getClass().getSimpleName()
    if kind == "ScalaUDF":
        return e.function().getClass().getName()
    if not kind.startswith("Python") or not hasattr(e, "func"):
        return None
    code = bytes(int(x) & 255 for x in e.func().command().mkString(",").split(","))
    h = hashlib.sha1(code)
    try:
        loaded = CloudPickleSerializer().loads(code)
    except (ImportError, AttributeError, pickle.UnpicklingError):
        loaded = ()
    for f in loaded if isinstance(loaded, tuple) else (loaded,):
        source = getattr(sys.modules.get(getattr(f, "__module__", None) or ""), "__file__", None)
        if callable(f) and source and Path(source).is_file():
            h.update(Path(source).read_bytes())
    return h.hexdigest()


def plan_identity(df: DataFrame) -> str:
    """Hash of what ``df`` computes: its analysed plan (expression numbers in
    order of appearance, so that the same query built again is the same), the
    identity of every input, the code of user functions, the schema and the
    settings in ``SETTINGS``.  ``ValueError`` when an input has no identity."""
    spark, plan = df.sparkSession, df._jdf.queryExecution().analyzed()
    text = plan.treeString(True, False, 2**31 - 1, False, False)
    numbers: dict[str, int] = {}
    text = re.sub(r"\b(\w+?)_\d+(?=#\d)", r"\1", text)  # numbered lambda variables
    text = re.sub(r"#(\d+)", lambda m: f"#{numbers.setdefault(m[1], len(numbers))}", text)
    parts = [text, df.schema.json(), *[f"{k}={spark.conf.get(k, None)}" for k in SETTINGS]]
    for node in _nodes(plan):
        if not node.children().size():
            parts.append(_leaf_identity(node, spark))
        parts += [x for x in map(_function_identity, _expressions(node)) if x]
    return hashlib.sha256("\x00".join(parts).encode()).hexdigest()


def _file_states(spark, files) -> Iterator[tuple[str, int, int]]:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for f in sorted(files):
        path = jvm.org.apache.hadoop.fs.Path(f)
        status = path.getFileSystem(conf).getFileStatus(path)
        yield f, status.getLen(), status.getModificationTime()


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads (0 for tables made in memory)."""
    return sum(size for _, size, _ in _file_states(df.sparkSession, df.inputFiles()))


def stage_path(root: str, stage: str, params: dict) -> str:
    key = hashlib.sha1(json.dumps(params, sort_keys=True, default=str).encode()).hexdigest()[:16]
    return f"{root.rstrip('/')}/{stage}-{key}"


def committed(spark, path: str) -> bool:
    """True when a write to ``path`` finished: the job commit leaves ``_SUCCESS``."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return bool(marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker))


def materialise(df: DataFrame, stage: str, params: dict | None = None, root: str | None = None,
                identity: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and return the table read back; a later call
    with the same query reads the existing table.  The same query is the same
    plan over the same input files (by size and time) with the same user
    functions, and the same ``params`` and library code: two filters of one
    source are two tables.  Input without an identity (rows made on the driver,
    RDDs) is an error unless the caller vouches for the query with
    ``identity``.  The default root is the shared checkpoint folder, so it also
    cuts lineage and survives executor loss.

    A table counts as present only when its write committed (``_SUCCESS``);
    the leftovers of a job that died mid-write are overwritten, never read.
    """
    spark = df.sparkSession
    root = root or f"{checkpoint_dir(spark)}/stages"
    path = stage_path(root, stage, {**(params or {}), "_query": identity or plan_identity(df), "_code": code_version()})
    if not committed(spark, path):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def pending(df: DataFrame, done: DataFrame, key: str | list[str] = "id") -> DataFrame:
    """Rows of ``df`` whose key is not yet in ``done`` (resume after a crash)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(done.select(*keys), keys, "left_anti")
