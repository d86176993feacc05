"""Session settings the jobs are meant to run with."""

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan at run time: merge small shuffle partitions, split skewed joins,
    # turn joins with a small measured side into broadcast joins.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

# Data per task that stays well inside an executor's memory.
BYTES_PER_TASK = 128 * 1024 * 1024
# A shuffle has a block for every pair of a writing and a reading task, so on
# very large inputs tasks get larger instead of more.
MOST_TASKS = 100_000


def sized_settings(input_bytes: int) -> dict[str, str]:
    """Scan and shuffle sizes for an input of this size.

    The widest shuffle (removing duplicates) moves about as much as is read.
    Small shuffles lose nothing: adaptive execution merges their partitions.
    """
    per_task = max(BYTES_PER_TASK, -(-input_bytes // MOST_TASKS))
    return {
        "spark.sql.files.maxPartitionBytes": str(per_task),
        "spark.sql.shuffle.partitions": str(max(200, -(-input_bytes // per_task))),
    }


def build_session(
    app_name: str = "stallwise", master: str | None = None, input_bytes: int | None = None, **settings
) -> SparkSession:
    """A session with the settings above; keyword values (dots as __) override them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = {} if input_bytes is None else sized_settings(input_bytes)
    chosen = SETTINGS | sized | {key.replace("__", "."): str(value) for key, value in settings.items()}
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
