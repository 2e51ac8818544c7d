"""Writers."""

from readmap.sinks.fastq import fastq_lines, qseq_lines, write_striped, write_tagged_fastq
from readmap.sinks.report import write_report

__all__ = ["fastq_lines", "qseq_lines", "write_report", "write_striped", "write_tagged_fastq"]
