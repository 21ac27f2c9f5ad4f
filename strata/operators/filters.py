"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import payload as P
from strata.operators.skew import lookup_join


def split_successful(responses: DataFrame, status: str = "status_code") -> tuple[DataFrame, DataFrame]:
    """(rows with status 200, all others with a reason)."""
    good = responses.where(F.col(status) == 200)
    bad = responses.where(~F.coalesce(F.col(status) == 200, F.lit(False)))
    return good, bad.withColumn(
        "reject_reason", F.concat(F.lit("status "), F.coalesce(F.col(status).cast("string"), F.lit("?")))
    )


def split_at_first_failure(
    responses: DataFrame,
    run: Sequence[str] = ("run_id",),
    ord: str = "ord",
    status: str = "status_code",
    body: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows of each run before its first failing response, all others with a reason).

    With ``body``, a good response whose body is not JSON is a failure as well.
    The first failure per run is a partial aggregate over the failing rows only,
    and the rows of a hot run are spread; no run is gathered into one task.
    """
    bad_status = (F.col(status) >= 400) | F.col(status).isNull()
    unreadable = P.whole_json(F.col(body)).isNull() if body else F.lit(False)
    # The verdict on a row by itself is taken before the join: a body that nobody asks for is not moved.
    own = F.when(bad_status, F.concat(F.lit("status "), F.coalesce(F.col(status).cast("string"), F.lit("?")))).when(
        unreadable, F.lit("body is not JSON")
    )
    judged = responses.withColumn("_own", own)
    first = judged.where(F.col("_own").isNotNull()).groupBy(*run).agg(F.min(ord).alias("_first_failure"))
    marked = lookup_join(judged, first, run, "left", [ord])
    kept = F.col("_first_failure").isNull() | (F.col(ord) < F.col("_first_failure"))
    reason = F.coalesce("_own", F.lit("after a failure"))
    return (
        marked.where(kept).select(*responses.columns),
        marked.where(~kept).select(*responses.columns, reason.alias("reject_reason")),
    )


def before_first_failure(responses: DataFrame, run: Sequence[str] = ("run_id",), ord: str = "ord", status: str = "status_code") -> DataFrame:
    """Rows of each run that precede its first failing response."""
    return split_at_first_failure(responses, run, ord, status)[0]


def normalised(c: Column) -> Column:
    return F.lower(F.trim(c))


def match_terms(entities: DataFrame, terms: DataFrame, name: str = "name", term: str = "term") -> DataFrame:
    """Entities whose name equals a search term, ignoring case and outer blanks."""
    wanted = terms.select(normalised(F.col(term)).alias("_term"))
    return entities.join(wanted, normalised(F.col(name)) == F.col("_term"), "left_semi")


def containing_terms(entities: DataFrame, terms: Sequence[str], name: str = "name") -> DataFrame:
    """Entities whose name contains one of the configured terms."""
    text = F.lower(F.col(name))
    hits = [text.contains(t.strip().lower()) for t in terms]
    return entities.where(reduce(lambda a, b: a | b, hits, F.lit(False)))


def in_country(df: DataFrame, code: str, country: str = "country") -> DataFrame:
    return df.where(F.col(country) == code)


def split_objects(rows: DataFrame, element: str = "element") -> tuple[DataFrame, DataFrame]:
    """(JSON objects, everything else with a reason)."""
    is_object = F.coalesce(F.ltrim(F.col(element)).startswith("{"), F.lit(False))
    return rows.where(is_object), rows.where(~is_object).withColumn(
        "reject_reason", F.lit("not an object")
    )
