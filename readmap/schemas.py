"""Schemas of the tables the library reads and writes."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()

READ = _struct(name=_S, read_no=_I, sequence=_S, quality=_S)
READ_PERMISSIVE = T.StructType(READ.fields + _struct(_corrupt_reason=_S, _file=_S, _offset=_L, _corrupt_record=_S).fields)
PAIR = _struct(name=_S, seq1=_S, qual1=_S, seq2=_S, qual2=_S)
_B = T.BooleanType()
READ_PAIR = _struct(name=_S, has1=_B, seq1=_S, qual1=_S, has2=_B, seq2=_S, qual2=_S, row=_L)
MASK = _struct(barcode=_L, x=_I, y=_I)
ADAPTER = _struct(adapter=_S)
CANDIDATE = _struct(barcode=_L, name=_S, sequence=_S, quality=_S, umi=_S, umi_qual=_S)
TAGGED = _struct(name=_S, sequence=_S, quality=_S, umi=_S, umi_qual=_S, x=_I, y=_I)
BLOCK = _struct(file=_S, block_no=_I, start=_L, length=_L)
BLOCK_GROUP = T.StructType(
    _struct(file=_S, group_no=_I, start=_L, length=_L).fields
    + [T.StructField("payload", T.BinaryType(), True)]
)
COUNTERS = _struct(
    mask_rows=_L, total=_L, adapter=_L, short_reads=_L, umi_bad=_L, mapped=_L, bq=_L, uq=_L, rq=_L, rb=_L
)
