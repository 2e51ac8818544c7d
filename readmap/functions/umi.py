"""UMI quality."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def umi_bad(umi, quality) -> Column:
    """True for a UMI with an N, with two or more bases below Q10, or of nothing but A.

    An empty UMI counts as nothing but A.
    """
    umi = F.upper(F.col(umi) if isinstance(umi, str) else umi)
    quality = F.col(quality) if isinstance(quality, str) else quality
    two_below_q10 = F.rlike(quality, F.lit(r"[\x00-*][^\x00-*]*[\x00-*]"))
    only_a = F.length(F.replace(umi, F.lit("A"), F.lit(""))) == 0
    return F.contains(umi, F.lit("N")) | only_a | two_below_q10
