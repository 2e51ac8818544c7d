"""For each query the SQL that DuckDB runs on the same tables."""


def _bases(prefix: str, number: str, n: int = 32) -> str:
    return (
        f"substring(translate(md5('{prefix}' || cast({number} as varchar)),"
        f"'0123456789abcdef','ACTGACTGACTGACTG'),1,{n})"
    )


def _qualities(prefix: str, number: str) -> str:
    return f"translate(md5('{prefix}' || cast({number} as varchar)),'0123456789abcdef','!+5?@ABCDEFGHI#)')"


def _encode(window: str, n: int = 25) -> str:
    return (
        f"cast(list_sum(list_transform(range({n}), lambda i: "
        f"((ascii(substring({window}, cast(i + 1 as int), 1)) & 6) >> 1)::BIGINT << (2 * i)::BIGINT)) as bigint)"
    )


def _q30(quality: str) -> str:
    return f"length(regexp_replace({quality}, '[!->]', '', 'g'))"


def _umi_bad(umi: str, quality: str) -> str:
    return (
        f"(upper({umi}) like '%N%' or length(regexp_replace({quality}, '[+-~]', '', 'g')) > 1"
        f" or length(replace(upper({umi}), 'A', '')) = 0)"
    )


ADAPTER_HIT = "(contains(seq2, 'ACTGAC') or contains(seq2, 'GGGGG'))"

# Read pairs, mask, and pairs with everything that is computed on them.
R = f"""r as (
  select event_id, user_id, 'E' || cast(event_id as varchar) as name,
         {_bases('b', 'user_id', 25)}
         || case when event_id % 17 = 0 then 'NACGTACGTA' when event_id % 23 = 0 then 'AAAAAAAAAA'
                 else {_bases('u', 'event_id', 10)} end as seq1,
         {_qualities('q', 'event_id')} || 'III' as qual1,
         {_bases('r', 'event_id')} || {_bases('s', 'event_id')} as seq2,
         {_qualities('v', 'event_id')} || {_qualities('w', 'event_id')} as qual2
  from events)"""
M = f"""m as (
  select {_encode('bc')} as barcode, x, y from (
    select {_bases('b', 'c_custkey', 25)} as bc, cast(c_custkey % 50 as int) as x,
           cast(c_custkey // 50 as int) as y
    from customer where c_custkey % 3 <> 0
    union all
    select {_bases('b', 'c_custkey', 25)}, 900, 900 from customer where c_custkey % 10 = 1))"""


def _pairs(source: str = "r") -> str:
    return f"""p as (
  select name, seq2 as sequence, qual2 as quality, {_encode('seq1')} as barcode,
         substring(seq1, 26, 10) as umi, substring(qual1, 26, 10) as umi_qual,
         {ADAPTER_HIT} as adapter,
         {_umi_bad('substring(seq1, 26, 10)', 'substring(qual1, 26, 10)')} as umi_bad,
         {_q30('substring(qual1, 1, 25)')} as bq, {_q30('substring(qual1, 26, 10)')} as uq,
         {_q30('qual2')} as rq, length(seq2) as rb
  from {source})"""


P = _pairs()
TAGGED = """select name, sequence, quality, umi, umi_qual, x, y
  from p join {mask} using (barcode) where not adapter and not umi_bad"""
T = "t as (" + TAGGED.format(mask="m") + ")"
UNIQUE = "unique_m as (select barcode, min(x) as x, min(y) as y from m group by barcode having count(*) = 1)"


def _counters(source: str = "p") -> str:
    def bigint(expression: str, name: str) -> str:
        return f"cast(coalesce({expression}, 0) as bigint) as {name}"

    return f"""c as (select (select count(*) from m) as mask_rows, count(*) as total,
  {bigint('sum(adapter::int)', 'adapter')}, cast(0 as bigint) as short_reads,
  {bigint('sum((not adapter and umi_bad)::int)', 'umi_bad')},
  (select count(*) from {source} q join m using (barcode) where not q.adapter and not q.umi_bad) as mapped,
  {bigint('sum(bq) filter (where not adapter)', 'bq')}, {bigint('sum(uq) filter (where not adapter)', 'uq')},
  {bigint('sum(rq) filter (where not adapter)', 'rq')}, {bigint('sum(rb) filter (where not adapter)', 'rb')}
  from {source})"""


UNEVEN1 = """r1 as (select name || case when event_id % 13 = 0 then '-1' else '' end as name, seq1, qual1
  from r, range(2) t(i) where i = 0 or event_id % 19 = 0)"""
UNEVEN2 = """r2 as (select name || case when event_id % 11 = 0 then '-2' else '' end as name, seq2, qual2
  from r, range(2) t(i) where i = 0 or event_id % 29 = 0)"""
UNEVEN = "u as (select r1.name, seq1, qual1, seq2, qual2 from r1 join r2 on r1.name = r2.name)"

# Fixed value: characters of the two quality encodings, as SQL strings.
SANGER = "".join(chr(c) for c in range(33, 96)).replace("'", "''")
ILLUMINA = "".join(chr(c) for c in range(64, 127)).replace("'", "''")

TAGGED_NAME = "name || '|||CB:Z:' || x || '_' || y || '|||UR:Z:' || umi || '|||UY:Z:' || umi_qual"
CAPTURED = f"g as (select {_encode('seq1')} as barcode, count(*) as reads from r group by 1)"


def _altered(bits: int) -> str:
    return f"""a as (select distinct case when event_id % 3 = 0
    then xor(key, (1 + event_id % 3)::BIGINT << ({bits} * (event_id % 25))::BIGINT) else key end as barcode
  from (select event_id, {_encode('seq1')} as key from r))"""


def _one_mismatch(bits: int, source: str, length: int = 25, positions: str = "m") -> str:
    """Unmapped barcodes of ``a`` with their neighbours in the mask, for steps of so many bits."""
    return f"""k as (select distinct k::BIGINT << (({bits} * i)::BIGINT) as step from range(1, 4) a(k), range({length}) b(i)),
  n as (select barcode, xor(barcode, step) as mask_barcode from {source}, k
        where barcode not in (select barcode from m)),
  h as (select barcode, min(mask_barcode) as mask_barcode
        from (select distinct barcode, mask_barcode from n
              where mask_barcode in (select barcode from m))
        group by barcode having count(*) = 1),
  o as (select h.barcode, mask_barcode, x, y from h join {positions} p on p.barcode = mask_barcode)"""


# Every fourth read 1 with one base changed.
ERRORS = """e as (
  select * replace (case when event_id % 4 = 0 then
    left(seq1, cast(event_id % 25 as int))
    || translate(substring(seq1, cast(event_id % 25 as int) + 1, 1), 'ACTG', 'CTGA')
    || substring(seq1, cast(event_id % 25 as int) + 2) else seq1 end as seq1) from r)"""
# Barcode and UMI in read 2, read 1 of no use: the pairs of ``r`` with read 1 searched for adapters.
FROM_READ2 = _pairs().replace("seq2 as sequence, qual2 as quality", "seq1 as sequence, qual1 as quality").replace(
    ADAPTER_HIT, ADAPTER_HIT.replace("seq2", "seq1")
)


def _with(*tables: str, then: str) -> str:
    return "with " + ",\n".join(tables) + "\n" + then


def _rotated(window: str, bits: int) -> str:
    """A 50-bit key moved up, what passes bit 63 coming back at the bottom, as a signed number."""
    key = f"{_encode(window)}::HUGEINT * {2**bits}::HUGEINT"
    wrapped = f"(({key}) % 18446744073709551616::HUGEINT + ({key}) // 18446744073709551616::HUGEINT)"
    return (
        f"cast(case when {wrapped} >= 9223372036854775808::HUGEINT"
        f" then {wrapped} - 18446744073709551616::HUGEINT else {wrapped} end as bigint)"
    )


def _reads(read: int, source: str = "r") -> str:
    return f"select name, cast({read} as int) as read_no, seq{read} as sequence, qual{read} as quality from {source}"


def _percent(part: str, whole: str) -> str:
    """Two decimals, halves away from zero, from the shortest digits of the double."""
    ratio = f"cast(cast(cast({part} as double) / cast({whole} as double) * 100 as varchar) as decimal(30, 18))"
    return f"cast(round({ratio}, 2) as varchar) || '%'"


def _report_line(number: int, label: str, part: str, whole: str | None, with_count: bool) -> str:
    line = [f"'{label}:'"]
    if with_count:
        line.append(f"cast({part} as varchar)")
    if whole:
        line.append(_percent(part, whole))
    text = " || chr(9) || ".join(line)
    return (
        f"select cast({number} as int) as line_no, '{label}' as label, cast({part} as bigint) as numerator,"
        f" cast({whole or 'null'} as bigint) as denominator, {text} as line from c"
    )


REPORT = " union all ".join(
    [
        _report_line(1, "getBarcodePositionMap_uniqBarcodeTypes", "mask_rows", None, True),
        _report_line(2, "total_reads", "total", None, True),
        _report_line(3, "adapter_filtered_reads", "adapter", "total", True),
        _report_line(4, "umi_filtered_reads", "umi_bad", "(total - adapter)", True),
        _report_line(5, "mapped_reads", "mapped", "(total - adapter - umi_bad)", True),
        _report_line(6, "Q30_bases_in_barcode", "bq", "((total - adapter) * 25)", False),
        _report_line(7, "Q30_bases_in_umi", "uq", "((total - adapter) * 10)", False),
        _report_line(8, "Q30_bases_in_read", "rq", "rb", False),
    ]
)

MASK_ROWS = _with(M, then="select barcode, x, y from m")
RAW_NAME = """'E' || cast(event_id as varchar) || case event_id % 4
  when 0 then '/1' when 1 then '/12' when 2 then '/2 x' else '' end"""
MANY_ADAPTERS = f"""a as (select distinct substring({_bases('a', 's_suppkey')}, 1, cast(s_suppkey % 3 + 6 as int)) as adapter
  from supplier)"""
ODD_QUALITY = "case when event_id % 7 = 0 then replace(qual2, 'I', '~') else qual2 end"


def _first_bad(quality: str, low: str, high: str) -> str:
    clean = f"length(regexp_extract({quality}, '^[{low}-{high}]*'))"
    return f"cast(case when {clean} < length({quality}) then {clean} else -1 end as int)"


ORACLES = {
    "map_barcodes": _with(R, M, P, then=TAGGED.format(mask="m")),
    "map_barcodes_stored_mask": _with(R, M, P, then=TAGGED.format(mask="m")),
    "map_barcodes_unique_mask": _with(R, M, UNIQUE, P, then=TAGGED.format(mask="unique_m")),
    "map_barcodes_one_mismatch": _with(
        R,
        M,
        ERRORS,
        _pairs("e"),
        "a as (select distinct barcode from p where not adapter and not umi_bad)",
        _one_mismatch(2, "a"),
        "lookup as (select * from m union all select barcode, x, y from o)",
        then=TAGGED.format(mask="lookup"),
    ),
    "map_barcodes_unique_one_mismatch": _with(
        R,
        M.replace("m as (", "m25 as (", 1),
        "m as (select barcode & 4095 as barcode, x, y from m25)",
        UNIQUE,
        _pairs().replace(_encode("seq1"), _encode("seq1", 6)),
        "a as (select distinct barcode from p where not adapter and not umi_bad)",
        _one_mismatch(2, "a", 6, "unique_m"),
        "lookup as (select * from unique_m union all select barcode, x, y from o)",
        then=TAGGED.format(mask="lookup"),
    ),
    "map_barcodes_damaged": _with(
        R,
        M,
        _pairs("(select * from r where not ((event_id + 1) % 50 in (9, 25) or (event_id + 2) % 50 in (9, 25)))"),
        then=TAGGED.format(mask="m"),
    ),
    "map_barcodes_from_read2": _with(R, M, FROM_READ2, then=TAGGED.format(mask="m")),
    "pair_flags": _with(
        R, P, then="select name, barcode, umi, adapter, umi_bad, cast(rb as int) as read_bases from p"
    ),
    "run_counters": _with(R, M, P, _counters(), then="select * from c"),
    "run_counters_repeated_names": _with(
        R, M, UNEVEN1, UNEVEN2, UNEVEN, _pairs("u"), _counters(), then="select * from c"
    ),
    "stats_report": _with(R, M, P, _counters(), then=REPORT),
    "read_pairs": _with(R, UNEVEN1, UNEVEN2, UNEVEN, then="select * from u"),
    "read_pairs_in_step": _with(R, UNEVEN1, UNEVEN2, UNEVEN, then="select * from u"),
    "one_pass_counters": _with(R, M, UNEVEN1, UNEVEN2, UNEVEN, _pairs("u"), _counters(), then="select * from c"),
    "one_pass_reads": _with(R, M, P, T, then=f"select {TAGGED_NAME} as name, sequence, quality from t"),
    "barcode_umi_windows": _with(
        R,
        then="""select name, substring(seq1, 1, 25) as barcode_bases, substring(seq1, 26, 10) as umi,
        substring(qual1, 26, 10) as umi_qual, substring(seq2, 4, 20) as barcode_bases2,
        substring(seq2, 31, 8) as umi2, substring(qual2, 31, 8) as umi_qual2 from r""",
    ),
    "barcode_encode": _with(
        R,
        then=f"""select name, {_encode('seq1')} as barcode, {_rotated('seq2[21:45]', 40)} as barcode_at_20,
        {_encode('seq2[21:45]')} as window_at_20 from r""",
    ),
    "barcode_decode": f"""select cast(c_custkey % 50 as int) as x, cast(c_custkey // 50 as int) as y,
        {_bases('b', 'c_custkey', 25)} as bases from customer where c_custkey % 3 <> 0
        union all select 900, 900, {_bases('b', 'c_custkey', 25)} from customer where c_custkey % 10 = 1""",
    "read_names": f"""select raw, regexp_replace(raw, '/[0-9]$', '') as name,
        try_cast(regexp_extract(raw, '/([0-9])$', 1) as int) as read_no
        from (select {RAW_NAME} as raw from events)""",
    "adapter_filter": _with(R, then=f"select name, seq2 as sequence from r where not {ADAPTER_HIT}"),
    "adapter_filter_many": _with(
        R, MANY_ADAPTERS, then="select name, exists (select 1 from a where contains(seq2, a.adapter)) as adapter from r"
    ),
    "umi_filter": _with(
        R,
        then=f"""select name, substring(seq1, 26, 10) as umi,
        {_umi_bad('substring(seq1, 26, 10)', 'substring(qual1, 26, 10)')} as umi_bad from r""",
    ),
    "q30_per_read": _with(R, then=f"select name, cast({_q30('qual2')} as int) as q30 from r"),
    "quality_verify": _with(
        R,
        then=f"""select name, {_first_bad('q', '!', '_')} as bad_sanger, {_first_bad('q', '@', '~')} as bad_illumina
        from (select name, {ODD_QUALITY} as q from r)""",
    ),
    "quality_to_illumina": _with(R, then=f"select name, translate(qual2, '{SANGER}', '{ILLUMINA}') as quality from r"),
    "quality_from_illumina": _with(R, then="select name, qual2 as quality from r"),
    "mask_bin_scan": MASK_ROWS,
    "mask_txt_scan": MASK_ROWS,
    "adapter_scan": f"select distinct {_bases('a', 's_nationkey', 12)} as adapter from supplier",
    "fastq_scan": _with(R, then=_reads(1)),
    "fastq_gzip_scan": _with(R, then=_reads(2)),
    "fastq_block_gzip_scan": _with(R, then=_reads(2)),
    "fastq_block_gzip_scan_unindexed": _with(R, then=_reads(2)),
    "gzip_block_index": "select true as contiguous, true as covered",
    "gzip_block_payload": _with(
        R,
        then="""select cast(sum(length('@' || name || '/2') + length(seq2) + length('+') + length(qual2) + 4) as bigint)
        as text_bytes, true as whole, true as marked from r""",
    ),
    "fastq_validate": _with(
        R,
        then="""select reason, count(*) as records, cast(sum(characters) as bigint) as characters from (
          select case when (event_id + 2) % 50 = 9 then 'missing separator'
                      when (event_id + 2) % 50 = 25 then 'quality out of range' else 'none' end as reason,
                 case when (event_id + 2) % 50 in (9, 25) then length('@' || name) + 64 + 1 + 64 + 4 end as characters
          from r
          union all select 'truncated record', length('@' || name) + 9 + 2 from r where event_id % 1000 = 31)
        group by 1""",
    ),
    "fastq_round_trip": _with(R, M, P, T, then=f"select {TAGGED_NAME} as name, sequence, quality from t"),
    "tagged_fastq": _with(
        R,
        M,
        P,
        T,
        then=f"""select '@' || {TAGGED_NAME} || chr(10) || sequence || chr(10) || '+' || chr(10) || quality as value
        from t""",
    ),
    "tagged_fastq_gzip": _with(R, M, P, T, then=f"select {TAGGED_NAME} as name, sequence, quality from t"),
    "output_partitions": _with(R, M, P, T, then="select cast(32 as bigint) as files, count(*) as reads, cast(8 as bigint) as merged_files, count(*) as merged_reads from t"),
    "qseq_lines": _with(
        R,
        then="""select case when length(name) % 2 = 0 then '1' else 'null' end
        || chr(9) || seq1 || chr(9) || qual1 as line from r""",
    ),
    "captured_barcodes": _with(
        R, M, CAPTURED, then="select g.barcode, reads, x, y from g left join m on g.barcode = m.barcode"
    ),
    "mapped_barcodes": _with(R, M, CAPTURED, then="select * from g where barcode in (select barcode from m)"),
    "unmapped_barcodes": _with(R, M, CAPTURED, then="select * from g where barcode not in (select barcode from m)"),
    "unique_mask": _with(M, UNIQUE, then="select * from unique_m"),
    "unique_barcode_count": _with(M, UNIQUE, then="select count(*) as unique_barcodes from unique_m"),
    "one_mismatch_map": _with(R, M, _altered(2), _one_mismatch(2, "a"), then="select * from o"),
    "one_mismatch_ref_masks": _with(R, M, _altered(1), _one_mismatch(1, "a"), then="select * from o"),
    "distinct_reads": _with(
        R,
        UNEVEN1,
        then="""select cast(1 as int) as read_no, seq1 as sequence, qual1 as quality, count(*) as copies
        from r1 group by all""",
    ),
    "mask_position_order": _with(
        M,
        then="""select y, x, count(*) as n,
        cast(sum(count(*)) over (order by y, x) - count(*) + 1 as bigint) as rank from m group by y, x""",
    ),
    "captured_barcode_order": _with(
        R, CAPTURED, then="select barcode, row_number() over (order by barcode) as rank from g"
    ),
    "stripe_counts": _with(
        M, then="select cast(((x % 8) + 8) % 8 as int) as stripe, count(*) as positions from m group by 1"
    ),
    "striped_fastq": _with(
        R, M, P, T, then="select cast(((y % 8) + 8) % 8 as int) as stripe, count(*) as reads from t group by 1"
    ),
    "striped_fastq_round_trip": _with(R, M, P, T, then=f"select {TAGGED_NAME} as name, sequence, quality from t"),
    "barcode_bucket_counts": _with(
        M, then="select cast(((barcode % 16) + 16) % 16 as int) as bucket, count(*) as rows from m group by 1"
    ),
}
