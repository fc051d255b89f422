"""Cut input into files that a stream can admit a few at a time."""

from math import ceil

from ..sources.lines import drop_bad_lines, read_lines, stream_lines, strip_lines

MAX_ROWS_PER_FILE = 100_000
MIN_ROWS_PER_FILE = 250
MAX_FILES_PER_BATCH = 10_000


def land(lines, out_dir, rows_per_file=MAX_ROWS_PER_FILE, mode="errorifexists", compression=None):
    """Write lines as text files of at most ``rows_per_file`` rows, without a shuffle.

    A line must hold no line feed; JSON text holds none.
    """
    writer = lines.select("value").write.mode(mode).option("lineSep", "\n")
    if compression:
        writer = writer.option("compression", compression)
    writer.option("maxRecordsPerFile", int(rows_per_file)).text(out_dir)


def land_lines(spark, path, out_dir, rows_per_file=MAX_ROWS_PER_FILE, strip=True,
               on_bad="keep", **write_options):
    """Land a line file or folder. ``on_bad="drop"`` leaves out what is not JSON."""
    if on_bad not in ("keep", "drop"):
        raise ValueError(f"on_bad must be keep or drop, not {on_bad!r}")
    lines = read_lines(spark, path)
    if strip:
        lines = strip_lines(lines)
    if on_bad == "drop":
        lines = drop_bad_lines(lines)
    land(lines, out_dir, rows_per_file, **write_options)


def replay_stream(spark, landed_dir, files_per_trigger=None, bytes_per_trigger=None, archive_dir=None):
    """The landed lines as a stream; the limit paces it batch by batch."""
    return stream_lines(spark, landed_dir, files_per_trigger, bytes_per_trigger, line_sep="\n",
                        archive_dir=archive_dir)


def pace(rows, slots, batches=4):
    """(rows per file, files per batch) for about ``batches`` batches.

    Files are small enough to keep ``slots`` tasks busy, within MIN_ROWS_PER_FILE
    and MAX_ROWS_PER_FILE. A batch gets at most MAX_FILES_PER_BATCH files, so that
    little is repeated after a failure; larger inputs take more batches instead.
    """
    rows_per_file = min(max(ceil(rows / (batches * slots)), MIN_ROWS_PER_FILE), MAX_ROWS_PER_FILE)
    files = ceil(rows / rows_per_file)
    return rows_per_file, max(1, min(ceil(files / batches), MAX_FILES_PER_BATCH))
