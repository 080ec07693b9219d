"""Execution plans: how Spark runs user functions. A plan is strict: what it cannot run is an error, not run otherwise."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

#: Names that stand for a plan.
SHORTCUTS = {"reference": "reference", "direct_serial": "reference", "pickled": "pickled", "inproc": "pickled", "direct_main_queue": "pickled", "arrow": "arrow", "ipc": "arrow", "ipc_nng_pool": "arrow"}
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_REUSE = "spark.python.worker.reuse"


@dataclass(frozen=True)
class Plan:
    """``arrow``: columns go to Python workers in batches. ``pickled``: rows do. ``reference``: as pickled,
    for comparisons in tests. A function keeps the plan under which it was registered.

    batch_rows: rows of an Arrow batch. most_bytes: size of a pickled function that is an error (it
    goes to every task; data belongs in a broadcast variable); half of it is a warning.
    """

    name: str = "arrow"
    batch_rows: int = 10_000
    most_bytes: int = 16 << 20

    def __post_init__(self) -> None:
        if self.name not in ("arrow", "pickled", "reference"):
            raise ValueError(f"no such plan: {self.name!r}")
        if self.batch_rows < 1 or self.most_bytes < 1:
            raise ValueError("batch_rows and most_bytes are positive")

    def allows(self, mode: str, n_args: int | None) -> None:
        """Raises if functions of that mode cannot run under the plan."""
        if mode not in ("scalar", "vectorized"):
            raise ValueError(f"no such mode: {mode!r}")
        if mode == "vectorized":
            if self.name != "arrow":
                raise ValueError(f"vectorized functions need the arrow plan, not {self.name}")
            if n_args == 0:
                raise ValueError("a vectorized function needs an argument, for the number of rows")


def plan(name: str | Plan, **options: int) -> Plan:
    if isinstance(name, Plan):
        return name
    if name not in SHORTCUTS:
        raise ValueError(f"no such plan: {name!r}; one of {', '.join(SHORTCUTS)}")
    return Plan(SHORTCUTS[name], **options)


def apply(spark: SparkSession, new: Plan) -> None:
    """Sets what the plan needs in the session; as it was before, if that fails."""
    before = spark.conf.get(_BATCH)
    try:
        spark.conf.set(_BATCH, str(new.batch_rows))
        if spark.conf.get(_BATCH) != str(new.batch_rows):
            raise RuntimeError(f"{_BATCH} could not be set")
    except Exception:
        spark.conf.set(_BATCH, before)
        raise


def backend(spark: SparkSession) -> dict[str, object]:
    """What runs the Python workers: master, cores, whether workers are kept, rows of a batch."""
    context = spark.sparkContext
    return {"master": context.master, "parallelism": context.defaultParallelism, "worker_reuse": context.getConf().get(_REUSE, "true") == "true", "batch_rows": int(spark.conf.get(_BATCH))}
