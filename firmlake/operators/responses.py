"""From single calls to the record that is stored for a company.

A call is identified by ``call_keys``. Each operator is one grouped aggregate with partial aggregation before its
shuffle; the only lists built are the pages of a call, one row for each page number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlake.operators.latest import first_per
from firmlake.registry import PAGE_SIZE

HTTP_ERROR, OTHER_ERROR = -1, -2


def merge_pages(
    pages: DataFrame,
    call_keys: Sequence[str],
    newest_first: Sequence[Column],
    page_size: int = PAGE_SIZE,
    max_pages: int | None = None,
) -> DataFrame:
    """One response per call from its pages (``page_num, error_code, total, items``).

    Page 1 decides the status and the total. Pages follow in order up to the page count of the total and stop before
    the first page that failed or is missing. A log may repeat pages; ``newest_first`` is the order that picks one row of
    each. All stored pages count unless ``max_pages`` sets a limit. An ``envelope`` column is kept as it is on page 1.
    """
    first = F.col("page_num") == 1
    kept = [c for c in ("envelope",) if c in pages.columns]
    wanted_pages = pages.where(F.col("page_num") >= 1 if max_pages is None else F.col("page_num").between(1, max_pages))
    wanted_pages = first_per(wanted_pages, [*call_keys, "page_num"], newest_first)
    called = wanted_pages.groupBy(*call_keys)
    gathered = called.agg(
        F.max(F.when(first, F.col("error_code"))).alias("status_code"),
        F.max(F.when(first, F.col("total"))).alias("total"),
        F.min(F.when(F.col("error_code") != 0, F.col("page_num"))).alias("failed_at"),
        F.array_sort(F.collect_list(F.struct("page_num", "items"))).alias("pages"),
        *[F.max(F.when(first, F.col(c))).alias(c) for c in kept],
    )
    wanted = F.greatest(F.lit(1), F.ceil(F.coalesce("total", F.lit(0)) / page_size).cast("int"))
    good = F.filter(
        "pages",
        lambda p, i: (p["page_num"] == i + 1)
        & (p["page_num"] <= wanted)
        & F.coalesce(p["page_num"] < F.col("failed_at"), F.lit(True)),
    )
    merged = gathered.where(F.col("status_code").isNotNull()).withColumn("good", good)
    items = F.flatten(F.transform(F.filter("good", lambda p: p["items"].isNotNull()), lambda p: p["items"]))
    return merged.select(
        *call_keys,
        "status_code",
        "total",
        F.size("good").alias("pages_used"),
        F.when(F.col("status_code") == 0, items).alias("items"),
        *kept,
    )


def _is_object(payload: Column) -> Column:
    """True for the text of a JSON object: one that can be read and opens with a brace."""
    return payload.rlike("^[\\s\ufeff]*\\{") & F.try_parse_json(payload).isNotNull()


def _members(payload: Column) -> Column:
    """Members of a JSON object as a map of variants; null for anything else."""
    return F.from_json(F.when(_is_object(payload), payload), "map<string,variant>")


def _with_result(payload: Column, result: Column) -> Column:
    """JSON text of an object with its member ``result`` replaced, the others as they are."""

    def member(entry: Column) -> Column:
        name = F.to_json(F.array(entry["key"]))
        value = F.when(entry["key"] == "result", result).otherwise(F.to_json(entry["value"]))
        return F.concat(F.regexp_replace(name, r"^\[|\]$", ""), F.lit(":"), value)

    return F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(_members(payload)), member), ","), F.lit("}"))


def merge_responses(
    pages: DataFrame,
    call_keys: Sequence[str],
    newest_first: Sequence[Column],
    page_size: int = PAGE_SIZE,
    max_pages: int | None = None,
) -> DataFrame:
    """(call_keys, status_code, output_result, pages_used): the record to store for each call, from its page responses.

    ``pages`` holds ``page_num`` and the response text as ``payload``. A failed first page is stored as it is with its code, -1
    where it has none or is no JSON object; so is a successful one whose result is empty or whose total fits on one page. Else the
    record is page 1 with ``result`` replaced by its total and the items of all pages, which is what a parser of a paged interface
    reads. Pages follow and stop as in ``merge_pages``; a later page that is no JSON object has failed.
    """
    payload = F.col("payload")
    code = F.coalesce(F.when(_is_object(payload), F.get_json_object(payload, "$.error_code").try_cast("int")), F.lit(HTTP_ERROR))
    listed = F.get_json_object(payload, "$.result.items")
    inside = F.regexp_replace(listed, r"^\[|\]$", "")
    decoded = pages.select(
        *call_keys, *[c for c in pages.columns if c not in (*call_keys, "payload", "items", "total", "error_code", "envelope")],
        code.alias("error_code"),
        F.get_json_object(payload, "$.result.total").try_cast("int").alias("total"),
        F.when(listed.startswith("[") & (inside != ""), F.array(inside)).alias("items"),
        F.when(F.col("page_num") == 1, payload).alias("envelope"),
    )
    merged = merge_pages(decoded, call_keys, newest_first, page_size, max_pages)
    total = F.coalesce("total", F.lit(0))
    result = F.concat(F.lit('{"total":'), total.cast("string"), F.lit(',"items":['), F.array_join("items", ","), F.lit("]}"))
    whole = (F.col("status_code") != 0) | (total <= page_size)
    stored = F.when(whole, F.col("envelope")).otherwise(_with_result(F.col("envelope"), result))
    return merged.select(*call_keys, "status_code", stored.alias("output_result"), "pages_used")


def resolve_attempts(
    attempts: DataFrame,
    call_keys: Sequence[str],
    normal_codes: Column | None = None,
    retries: Column | None = None,
    stops_at_normal_code: Column | None = None,
) -> DataFrame:
    """Outcome of each call from its attempt log (``attempt, code, payload``).

    The first success ends a call, so does a normal code where the interface stops at those. All attempts of the log count,
    or just the first where ``retries`` is not true, as every query is billed there. Without an end the last attempt gives
    the outcome.
    """
    counts = F.lit(True) if retries is None else F.coalesce(retries, F.lit(False)) | (F.col("attempt") <= 1)
    ends = F.col("code") == 0
    if normal_codes is not None and stops_at_normal_code is not None:
        ends = ends | (stops_at_normal_code & F.coalesce(F.array_contains(normal_codes, F.col("code")), F.lit(False)))
    outcome = F.struct("attempt", "code", "payload")
    counted = attempts.where(counts).withColumn("_ends", ends)
    resolved = counted.groupBy(*call_keys).agg(
        F.min_by(outcome, F.when(F.col("_ends"), F.col("attempt"))).alias("ended"),
        F.max_by(outcome, "attempt").alias("last"),
    )
    final = F.coalesce("ended", "last")
    return resolved.select(
        *call_keys,
        final["attempt"].alias("attempts"),
        final["code"].alias("status_code"),
        final["payload"].alias("output_result"),
        F.when(final["code"] == 0, "SUCCESS").otherwise("FAILED").alias("outcome"),
    )


def failure_record(error_kind: Column, api_code: Column, message: Column, payload: Column) -> tuple[Column, Column]:
    """(status code, JSON detail): -1 for HTTP errors, -2 for others, else the provider's own code and response.

    ``error_kind`` is ``HTTP_EXCEPTION``, ``OTHER_EXCEPTION`` or NULL when the provider answered. A response that is
    not a JSON object is kept as ``raw_error``.
    """
    raised = F.when(error_kind == "HTTP_EXCEPTION", HTTP_ERROR).when(error_kind.isNotNull(), OTHER_ERROR)
    code = F.coalesce(raised, api_code, F.lit(HTTP_ERROR))
    detail = F.to_json(F.struct(error_kind.alias("error_type"), raised.alias("error_code"), message.alias("error_msg")))
    is_object = F.coalesce(F.to_json(F.try_parse_json(payload)).startswith("{"), F.lit(False))
    answered = F.when(is_object, payload).otherwise(F.to_json(F.struct(payload.alias("raw_error"))))
    return code.cast("int"), F.when(error_kind.isNotNull(), detail).otherwise(answered)
