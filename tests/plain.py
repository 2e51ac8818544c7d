"""The semantics once more, one Python object at a time, to compare with."""

BASES = "ACTG"


def signed(value):
    value &= (1 << 64) - 1
    return value - (1 << 64) if value >> 63 else value


def encode(sequence, start, length):
    key = 0
    for i in range(start, start + length):
        key |= ((ord(sequence[i]) >> 1) & 3) << (2 * i % 64)
    return signed(key)


def decode(key, length):
    return "".join(BASES[key >> (2 * i % 64) & 3] for i in range(length))


def umi_bad(umi, quality):
    low = sum(q < "+" for q in quality)
    return "N" in umi.upper() or low > 1 or all(b in "Aa" for b in umi)


def q30(quality):
    return sum(q >= "?" for q in quality)


def map_reads(mask, reads1, reads2, adapters, layout):
    """Counters and placed reads of lists of (name, sequence, quality) and (barcode, x, y)."""
    c = dict.fromkeys("mask_rows total adapter short_reads umi_bad mapped bq uq rq rb".split(), 0)
    c["mask_rows"] = len(mask)
    placed = []
    for name1, seq1, qual1 in reads1:
        for name2, seq2, qual2 in reads2:
            if name1 != name2:
                continue
            c["total"] += 1
            if any(a in seq2 for a in adapters):
                c["adapter"] += 1
                continue
            barcode_seq, barcode_qual = (seq1, qual1) if layout.barcode_read == 1 else (seq2, qual2)
            umi_seq, umi_qual = (seq1, qual1) if layout.umi_read == 1 else (seq2, qual2)
            barcode_end = layout.barcode_start + layout.barcode_len
            umi_end = layout.umi_start + layout.umi_len
            if min(len(barcode_seq), len(barcode_qual)) < barcode_end or min(len(umi_seq), len(umi_qual)) < umi_end:
                c["short_reads"] += 1
                continue
            umi, umi_q = umi_seq[layout.umi_start : umi_end], umi_qual[layout.umi_start : umi_end]
            c["bq"] += q30(barcode_qual[layout.barcode_start : barcode_end])
            c["uq"] += q30(umi_q)
            c["rq"] += q30(qual2)
            c["rb"] += len(seq2)
            if umi_bad(umi, umi_q):
                c["umi_bad"] += 1
                continue
            key = encode(barcode_seq, layout.barcode_start, layout.barcode_len)
            placed += [(name1, seq2, qual2, umi, umi_q, x, y) for b, x, y in mask if b == key]
    c["mapped"] = len(placed)
    return c, sorted(placed)
