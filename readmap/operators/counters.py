"""Run counters and the statistics report."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readmap.operators.layout import ReadLayout
from readmap.operators.pairing import mate1, mate2
from readmap.operators.salting import salted_join


def run_counters(
    reads1: DataFrame,
    reads2: DataFrame,
    mask: DataFrame,
    layout: ReadLayout = ReadLayout(),
    adapters=None,
    lookup: DataFrame | None = None,
) -> DataFrame:
    """All counters of a run, exactly, as one row.

    Pairs are counted without being built. Every counter is a sum over pairs of a factor of read 1
    times a factor of read 2, and over the pairs of one name that is the product of two sums. So both
    mates go, as numbers only, into one aggregate by name: one shuffle without sequences, and a name
    or barcode that holds much of the input is folded before it is shuffled.

    ``lookup`` replaces the mask for ``mapped`` (extra positions found by mismatch).
    """
    first, second = mate1(reads1, layout), mate2(reads2, layout, adapters)
    positions = (lookup if lookup is not None else mask).groupBy("barcode").agg(F.count("*").alias("_hits"))
    if layout.has_barcode(1):
        first = salted_join(first, positions, "barcode", ["name"], "left")
    else:
        second = salted_join(second, positions, "barcode", ["name"], "left")

    factors1 = {"n1": "1"} | _factors(layout, 1, "int(NOT short1)")
    usable2 = "int(NOT adapter AND NOT short2)"
    factors2 = (
        {"n2": "1", "adapter2": "int(adapter)"}
        | _factors(layout, 2, usable2)
        | {"bases2": f"{usable2} * read_bases", "q30_2": f"{usable2} * read_q30"}
    )
    names = [*factors1, *factors2]
    rows = _rows(first, factors1, names).union(_rows(second, factors2, names))
    sums = rows.groupBy("name").agg(*[F.sum(n).alias(n) for n in names])

    def total(left: str, right: str, name: str) -> Column:
        left = f"{left}1" if f"{left}1" in factors1 else "usable1"
        right = f"{right}2" if f"{right}2" in factors2 else "usable2"
        return F.expr(f"coalesce(sum({left} * {right}), 0) AS {name}")

    counters = sums.agg(
        total("n", "n", "total"),
        total("n", "adapter", "adapter"),
        total("usable", "usable", "_usable"),
        total("umi_bad", "umi_bad", "umi_bad"),
        total("mapped", "mapped", "mapped"),
        total("barcode_q30_", "barcode_q30_", "bq"),
        total("umi_q30_", "umi_q30_", "uq"),
        total("usable", "q30_", "rq"),
        total("usable", "bases", "rb"),
    )
    short = "total - adapter - _usable"
    if layout.mode == "FAILFAST":
        message = f"concat({short}, ' pairs shorter than their barcode or UMI window')"
        counters = counters.filter(f"CASE WHEN {short} > 0 THEN raise_error({message}) ELSE true END")
    mask_rows = mask.agg(F.count("*")).scalar()
    return counters.withColumn("mask_rows", mask_rows).selectExpr(
        "mask_rows", "total", "adapter", f"{short} AS short_reads", "umi_bad", "mapped", "bq", "uq", "rq", "rb"
    )


def _factors(layout: ReadLayout, read: int, usable: str) -> dict[str, str]:
    """What a read adds to its name's sums; a read that lacks a window adds ``usable`` for it."""
    factors = {f"usable{read}": usable}
    mapped = usable
    if layout.has_umi(read):
        factors[f"umi_bad{read}"] = f"{usable} * int(umi_bad)"
        factors[f"umi_q30_{read}"] = f"{usable} * umi_q30"
        mapped += " * int(NOT umi_bad)"
    if layout.has_barcode(read):
        factors[f"barcode_q30_{read}"] = f"{usable} * barcode_q30"
        mapped += " * coalesce(_hits, 0)"
    if mapped != usable:
        factors[f"mapped{read}"] = mapped
    return factors


def _rows(mate: DataFrame, factors: dict[str, str], names: list[str]) -> DataFrame:
    return mate.selectExpr("name", *[f"bigint({factors.get(n, '0')}) AS {n}" for n in names])


def stats_report(counters: DataFrame, layout: ReadLayout = ReadLayout()) -> DataFrame:
    """The report: ``line_no, label, numerator, denominator, line``; plain counts have no ratio."""
    clean = F.col("total") - F.col("adapter") - F.col("short_reads")

    # Labels and their order.
    lines = [
        ("getBarcodePositionMap_uniqBarcodeTypes", F.col("mask_rows"), None, True),
        ("total_reads", F.col("total"), None, True),
        ("adapter_filtered_reads", F.col("adapter"), F.col("total"), True),
        ("umi_filtered_reads", F.col("umi_bad"), clean, True),
        ("mapped_reads", F.col("mapped"), clean - F.col("umi_bad"), True),
        ("Q30_bases_in_barcode", F.col("bq"), clean * layout.barcode_len, False),
        ("Q30_bases_in_umi", F.col("uq"), clean * layout.umi_len, False),
        ("Q30_bases_in_read", F.col("rq"), F.col("rb"), False),
    ]
    structs = []
    for number, (label, part, whole, with_count) in enumerate(lines, start=1):
        text = [F.lit(f"{label}:")]
        if with_count:
            text.append(part.cast("string"))
        if whole is not None:
            text.append(F.concat(F.format_string("%.2f", _ratio(part, whole) * 100), F.lit("%")))
        structs.append(
            F.struct(
                F.lit(number).alias("line_no"),
                F.lit(label).alias("label"),
                part.alias("numerator"),
                (whole if whole is not None else F.lit(None)).cast("bigint").alias("denominator"),
                F.concat_ws("\t", *text).alias("line"),
            )
        )
    return counters.select(F.inline(F.array(*structs)))


def _ratio(part: Column, whole: Column) -> Column:
    """Division of doubles as IEEE has it: NaN for 0/0, infinite for n/0."""
    undefined = F.when(part == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), undefined)
