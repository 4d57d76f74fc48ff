"""Reading physical plans in tests."""

import contextlib
import io

from tripflow.session import setting


def plan(df) -> str:
    """The plan as ``explain`` prints it."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def final_plan(df) -> str:
    """The plan after adaptive re-planning, of the run that collects ``df``."""
    df.collect()
    return plan(df)


@contextlib.contextmanager
def settings(spark, values):
    with contextlib.ExitStack() as stack:
        for key, value in values.items():
            stack.enter_context(setting(spark, key, value))
        yield


# A partition counts as skewed here at a size that test tables reach.
SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.shuffle.partitions": "32",
}
