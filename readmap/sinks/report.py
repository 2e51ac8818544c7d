"""The statistics report as a text file."""

from pyspark.sql import DataFrame

from readmap.sources import files


def write_report(report: DataFrame, path: str) -> str:
    """Write the report's eight lines to a file on any file system; returns the text."""
    rows = report.select("line_no", "line").collect()
    text = "".join(row["line"] + "\n" for row in sorted(rows))
    filesystem, inner = files.open_path(path)
    with filesystem.open_output_stream(inner, compression=None) as out:
        out.write(text.encode())
    return text
