import datetime as dt
import gzip
import io
import tarfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tempspan.functions.columns import blank_to_null, to_day, to_double
from tempspan.operators.daily import daily_extremes
from tempspan.schema import OBSERVATION_FIELDS, TIME_FORMAT
from tempspan.sources import archives, streams
from tempspan.sources import observations as obs
from tempspan.sources.archives import read_archives
from tempspan.sources.headers import detect_headers, header_slices
from tempspan.sources.inventory import first_files, list_files, summarize_files
from tempspan.sources.lines import explode_lines, scan_lines
from tempspan.sources.observations import (
    attach_by_broadcast, attach_by_chunk, data_lines, file_headers, observations_from_lines,
    read_observations, slice_fields, spread_slices, union_sources, with_narrow,
)
from tests.files import FIELDS, HEADER_TEXT, document, header, observation, row, write

TIME = dt.datetime(2019, 11, 1, 0, 10)


def read(spark, path, **options):
    found = read_observations(spark, str(path), **options)
    return found.observations.orderBy("DTG", "LOCATION").collect(), found


def names(rejects):
    return sorted(r["source"].rsplit("/", 1)[1] for r in rejects.collect())


def test_types_and_values(spark, tmp_path):
    values = observation(TIME, "11.2", "10.0", LATITUDE="52.098872", U_BOOL_10="1", U_10=91)
    write(tmp_path / "a.txt", document([values]))
    rows, found = read(spark, tmp_path)
    assert [(f.name, f.dataType.simpleString()) for f in found.observations.schema] == [
        *OBSERVATION_FIELDS.items(), ("DATE", "date")]
    got = rows[0]
    assert (got.DTG, got.LOCATION, got.NAME) == ("2019-11-01 00:10:00", "260_T_a", "De Bilt")
    assert (got.TX_DRYB_10, got.TN_DRYB_10, got.LATITUDE, got.U_10) == (11.2, 10.0, 52.098872, 91.0)
    assert got.U_BOOL_10 == "1" and got.T_WETB_10 is None
    assert got.DATE == dt.date(2019, 11, 1)


def test_midnight_belongs_to_the_printed_day(spark, tmp_path):
    write(tmp_path / "a", document([observation("2019-11-02 00:00:00", 1.0)]))
    rows, _ = read(spark, tmp_path)
    assert rows[0].DATE == dt.date(2019, 11, 2)


def test_file_without_header_is_rejected(spark, tmp_path):
    write(tmp_path / "good.txt", document([observation(TIME, 1.0)]))
    write(tmp_path / "bad.txt", document([observation(TIME, 2.0)], head=False))
    write(tmp_path / "blank.txt", "\n")
    rows, found = read(spark, tmp_path)
    assert [r.TX_DRYB_10 for r in rows] == [1.0]
    assert names(found.rejects) == ["bad.txt", "blank.txt"]


def test_no_input_and_no_header_raise(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_observations(spark, str(tmp_path))
    write(tmp_path / "bad.txt", "no header here\n")
    with pytest.raises(ValueError):
        read_observations(spark, str(tmp_path))


def test_the_first_of_two_headers_counts(spark, tmp_path):
    late = header(default=30)
    text = document([observation(TIME, 3.5)]) + late + "\n" + row(
        observation("2019-11-01 00:20:00", 4.5)) + "\n"
    write(tmp_path / "a", text)
    rows, _ = read(spark, tmp_path)
    assert [r.TX_DRYB_10 for r in rows] == [3.5, 4.5]


def test_header_in_an_earlier_block_serves_the_whole_file(spark, tmp_path, set_conf):
    many = [observation(TIME + dt.timedelta(minutes=10 * i), i) for i in range(200)]
    late = header(default=30) + "\n" + row(observation("2020-01-01 00:00:00", 7.0)) + "\n"
    write(tmp_path / "a", document(many) + late)
    set_conf("spark.sql.files.maxPartitionBytes", "4096")
    set_conf("spark.sql.files.openCostInBytes", "0")
    rows, found = read(spark, tmp_path)
    assert scan_lines(spark, str(tmp_path)).select("offset").distinct().count() > 5
    assert [r.TX_DRYB_10 for r in rows] == [float(i) for i in range(200)] + [7.0]


def test_header_below_data_lines(spark, tmp_path):
    lines = [row(observation(TIME, 5.5)), header(), row(observation("2019-12-01 00:00:00", 6.5))]
    write(tmp_path / "a", "\n".join(lines))
    rows, _ = read(spark, tmp_path)
    assert [r.TX_DRYB_10 for r in rows] == [5.5, 6.5]


def test_reordered_fields(spark, tmp_path):
    values = observation(TIME, 20.5, 10.5, T_WETB_10=7.5, U_SEA_10=3)
    turned = [FIELDS[0], *FIELDS[:0:-1]]
    write(tmp_path / "a", document([values], turned))
    rows, _ = read(spark, tmp_path)
    got = rows[0]
    assert (got.TX_DRYB_10, got.TN_DRYB_10, got.T_WETB_10, got.U_SEA_10) == (20.5, 10.5, 7.5, 3.0)
    assert got.NAME == "De Bilt" and got.LATITUDE is None


def test_missing_field_is_null_and_leaves_its_neighbours_alone(spark, tmp_path):
    fields = [f for f in FIELDS if f not in ("NAME", "T_WETB_10")]
    write(tmp_path / "a", document([observation(TIME, 20.5, 10.5, LATITUDE=52.1)], fields))
    rows, _ = read(spark, tmp_path)
    got = rows[0]
    assert got.NAME is None and got.T_WETB_10 is None
    assert (got.LOCATION, got.LATITUDE, got.TN_DRYB_10, got.TX_DRYB_10) == (
        "260_T_a", 52.1, 10.5, 20.5)


def test_last_field_is_cut_at_the_header_unless_asked(spark, tmp_path):
    fields = ["DTG", "LOCATION", "TX_DRYB_10"]
    widths = {"DTG": 21, "LOCATION": 20, "TX_DRYB_10": 3}
    text = header(fields, widths).rstrip() + "\n" + row(
        observation(TIME, "12345678901234.5"), fields, widths) + "\n"
    write(tmp_path / "a", text)
    cut, _ = read(spark, tmp_path)
    whole, _ = read(spark, tmp_path, clip_last=False)
    assert cut[0].TX_DRYB_10 == 1234567890.0
    assert whole[0].TX_DRYB_10 == 12345678901234.5


def test_carriage_returns(spark, tmp_path):
    fields = [*FIELDS[:-2], "U_SEA_10", "U_10"]
    write(tmp_path / "a", document([observation(TIME, 1.5, U_10="91")], fields, newline="\r\n"))
    rows, _ = read(spark, tmp_path)
    assert rows[0].U_10 == 91.0 and rows[0].TX_DRYB_10 == 1.5


def test_comment_and_blank_lines_anywhere(spark, tmp_path):
    text = document([observation(TIME, 1.5)]) + "# remark\n     \n\n" + row(
        observation("2019-11-01 00:20:00", 2.5)) + "\n#" + row(observation(TIME, 9.0)) + "\n"
    write(tmp_path / "a", text)
    rows, _ = read(spark, tmp_path)
    assert [r.TX_DRYB_10 for r in rows] == [1.5, 2.5]


def test_bad_values_become_null_and_blank_keys_drop_the_row(spark, tmp_path):
    write(tmp_path / "a", document([
        observation(TIME, "x1.2", "NaN"),
        observation("2019-13-45 00:00:00", 2.0),
        observation("2019-11-03", 3.0),
        observation("", 4.0),
        observation("2019-11-04 00:00:00", 5.0, station=""),
    ]))
    rows, _ = read(spark, tmp_path)
    assert [(r.DTG, r.DATE, r.TX_DRYB_10, r.TN_DRYB_10) for r in rows] == [
        ("2019-11-01 00:10:00", dt.date(2019, 11, 1), None, None),
        ("2019-11-03", None, 3.0, None),
        ("2019-13-45 00:00:00", None, 2.0, None),
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_text_columns_do_not_depend_on_ansi_mode(spark, set_conf, ansi):
    set_conf("spark.sql.ansi.enabled", ansi)
    texts = ["1.5", " 2.5 ", "-0", "", "   ", "x", "NaN", "1e3", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = frame.select(to_double(F.col("t")), blank_to_null(F.col("t"))).collect()
    assert [r[0] for r in got] == [1.5, 2.5, 0.0, None, None, None, None, 1000.0, None]
    assert [r[1] for r in got] == ["1.5", " 2.5 ", "-0", None, None, "x", "NaN", "1e3", None]


def test_days_are_those_of_parsing_by_format(spark):
    days = ["2020-02-29 23:59:59", "2021-02-29 00:00:00", "2020-02-29", "", "20200229 000000",
            "2020-02-29 00:00:00", "2020-02-29 24:00:00", "2020-02-29 10:60:00", None, "x",
            "2020-2-29 00:00:00", "2020-02-29T00:00:00", "2020-02-29 00:00:00 ",
            "2020-02-29 00:00:0Z", "2020-02-29 00:00:00\n", "0000-01-01 00:00:00",
            "9999-12-31 00:00:00", "-020-02-29 00:00:00", "2020-02-29 00:00:00.5",
            "1582-10-10 00:00:00", "0001-01-01 00:00:00"]
    frame = spark.createDataFrame([(t,) for t in days], "t string")
    by_format = F.try_to_date("t", TIME_FORMAT)
    got = frame.select(to_day(F.col("t")).cast("string").alias("ours"),
                       by_format.cast("string").alias("theirs")).collect()
    assert [r.ours for r in got] == [r.theirs for r in got]
    assert sum(r.ours is not None for r in got) == 6


def test_nested_directories_gzip_and_hidden_names(spark, tmp_path):
    write(tmp_path / "x" / "y" / "a.txt", document([observation(TIME, 1.0)]))
    packed = document([observation("2019-11-01 00:20:00", 2.0)]).encode()
    (tmp_path / "x" / "b.gz").write_bytes(gzip.compress(packed))
    write(tmp_path / ".hidden", document([observation(TIME, 9.0)]))
    write(tmp_path / "_hidden", document([observation(TIME, 9.0)]))
    rows, _ = read(spark, tmp_path)
    assert [r.TX_DRYB_10 for r in rows] == [1.0, 2.0]


def test_damaged_file_fails_or_is_named(spark, tmp_path):
    write(tmp_path / "a.txt", document([observation(TIME, 1.0)]))
    (tmp_path / "b.gz").write_bytes(b"this is no gzip stream")
    with pytest.raises(Exception, match="b.gz|gzip"):
        read_observations(spark, str(tmp_path)).observations.collect()
    found = read_observations(spark, str(tmp_path), skip_damaged=True)
    assert [r.TX_DRYB_10 for r in found.observations.collect()] == [1.0]
    assert [(r.source.rsplit("/", 1)[1], r.reason) for r in found.rejects.collect()] == [
        ("b.gz", "damaged")]


def test_cut_file_fails_or_is_left_out_as_a_whole(spark, tmp_path):
    many = [observation(TIME + dt.timedelta(minutes=10 * i), f"{i * 7919 % 1000}.5")
            for i in range(3000)]
    packed = gzip.compress(document(many).encode())
    (tmp_path / "a.gz").write_bytes(packed[: len(packed) // 2])
    (tmp_path / "two streams.gz").write_bytes(
        gzip.compress(document(many[:5]).encode()) + gzip.compress(document(many[5:9]).encode()))
    with pytest.raises(Exception, match="a.gz|Unexpected end|EOF"):
        read_observations(spark, str(tmp_path)).observations.collect()
    found = read_observations(spark, str(tmp_path), skip_damaged=True)
    assert len(found.observations.collect()) == 9
    assert [(r.source.rsplit("/", 1)[1], r.reason) for r in found.rejects.collect()] == [
        ("a.gz", "damaged")]


def files_by_codec(tmp_path):
    """Whole and damaged files of every codec that Hadoop goes by a suffix for."""
    import bz2
    import zlib

    def blocks(codec, data, chunk):  # Hadoop's block format, two chunks to a block
        out = b""
        for at in range(0, len(data), 2 * chunk):
            block = data[at : at + 2 * chunk]
            out += len(block).to_bytes(4, "big")
            for start in range(0, len(block), chunk):
                packed = pa.Codec(codec).compress(block[start : start + chunk], asbytes=True)
                out += len(packed).to_bytes(4, "big") + packed
        return out

    many = [observation(TIME + dt.timedelta(minutes=10 * i), f"{i * 7919 % 1000}.5") for i in range(40)]
    text = document(many).encode()
    packed = {
        "gz": gzip.compress(text), "deflate": zlib.compress(text), "bz2": bz2.compress(text),
        "zst": pa.compress(text, codec="zstd", asbytes=True), "lz4": blocks("lz4_raw", text, 3000),
        "snappy": blocks("snappy", text, 3000),
    }
    for suffix, data in packed.items():
        (tmp_path / f"whole.{suffix}").write_bytes(data)
        (tmp_path / f"cut.{suffix}").write_bytes(data[: len(data) // 2])
        (tmp_path / f"tail.{suffix}").write_bytes(data[:-3])
        (tmp_path / f"odd.{suffix}").write_bytes(b"\x7f\x7f is no stream")
    (tmp_path / "padded.gz").write_bytes(packed["gz"] + bytes(3 << 20))
    (tmp_path / "two.gz").write_bytes(packed["gz"] * 2)
    (tmp_path / "garbage.gz").write_bytes(packed["gz"] + b"garbage")
    return packed


def test_damage_of_every_codec_is_named_and_the_others_are_read(spark, tmp_path):
    packed = files_by_codec(tmp_path)
    found = read_observations(spark, str(tmp_path), skip_damaged=True)
    named = {r.source.rsplit("/", 1)[1] for r in found.rejects.where("reason = 'damaged'").collect()}
    assert named == {f"{k}.{s}" for k in ("cut", "tail", "odd") for s in packed} | {"garbage.gz"}
    assert found.rejects.count() == len(named)
    assert found.observations.count() == 40 * (len(packed) + 3)  # a padded file, and two streams in one
    readable = {s for s in packed if s != "zst"}  # Spark lacks that codec here, the streams do not
    for suffix in readable:
        mine = read_observations(spark, str(tmp_path / f"whole.{suffix}"), skip_damaged=True).observations
        assert mine.collect() == read_observations(spark, str(tmp_path / f"whole.{suffix}")).observations.collect()


@pytest.mark.parametrize("pieces", [streams.gzip_pieces, streams.bzip2_pieces, streams.xz_pieces, streams.zstd_pieces])
def test_decompression_takes_fixed_memory(pieces):
    import bz2
    import lzma
    import resource

    pack = {streams.gzip_pieces: gzip.compress, streams.bzip2_pieces: bz2.compress, streams.xz_pieces: lzma.compress,
            streams.zstd_pieces: lambda d: pa.compress(d, codec="zstd", asbytes=True)}[pieces]
    once = pack(b"0" * (20 << 20))
    data = once * 10  # 200 MB out of a few hundred KB
    before, most, n = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, 0, 0
    for piece in pieces(io.BytesIO(data).read):
        most, n = max(most, len(piece)), n + len(piece)
    assert n == 200 << 20 and most <= streams.STEP
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 60_000


def test_a_large_file_streams_through_a_task_in_fixed_memory(spark, tmp_path):
    """300 MB of text from 300 KB, and an archive with a member of that size."""
    import resource

    line = header().encode() + b"\n" + row(observation(TIME, 1.0)).encode() + b"\n" + b"#" * 998 + b"\n"
    (tmp_path / "a.gz").write_bytes(gzip.compress(line) + gzip.compress((b"#" * 999 + b"\n") * 300_000))
    assert read_observations(spark, str(tmp_path), skip_damaged=True).observations.count() == 1

    def peak(batches):
        for batch in batches:
            for _ in streams.text_blocks(streams.text_pieces(*batch_source(batch))):
                pass
            yield pa.RecordBatch.from_pydict({"kb": [resource.getrusage(resource.RUSAGE_SELF).ru_maxrss]})

    def batch_source(batch):
        source = batch.column("source")[0].as_py()
        return source, streams.open_source(source, None)

    files = streams.files_to_stream(spark, str(tmp_path))
    assert files.mapInArrow(peak, "kb long").first().kb < 400_000


def test_storage_failures_are_no_damage(tmp_path):
    with pytest.raises(streams.StorageFailure):
        streams.open_source(f"file:{tmp_path}/none.gz", None)

    class Broken(io.RawIOBase):
        def read(self, n=-1):
            raise OSError("disk")

    with pytest.raises(OSError):
        list(streams.gzip_pieces(Broken().read))


def test_plan_does_not_grow_with_damaged_files(spark, tmp_path):
    def plan_size(count):
        for i in range(count):
            path = write(tmp_path / str(count) / f"f{i}.gz", "")
            path.write_bytes(b"no gzip")
        write(tmp_path / str(count) / "a", document([observation(TIME, 1.0)]))
        found = read_observations(spark, str(tmp_path / str(count)), skip_damaged=True)
        assert found.observations.count() == 1 and found.rejects.count() == count
        return len(found.observations._jdf.queryExecution().analyzed().toString().replace(str(count), "n"))

    assert abs(plan_size(3) - plan_size(400)) < 60


def test_text_blocks_end_at_line_ends_and_refuse_endless_lines(monkeypatch):
    text = b"".join(bytes([97 + i % 26]) * (i * 37 % 90) + b"\n" for i in range(500))
    for step in (1, 7, 64, 4096):
        pieces = (text[i : i + step] for i in range(0, len(text), step))
        blocks = list(streams.text_blocks(pieces, 100))
        assert b"\n".join(b for _, b in blocks) + b"\n" == text
        assert all(text[o : o + len(b)] == b for o, b in blocks)
    monkeypatch.setattr(streams, "LINE_BYTES", 1000)
    with pytest.raises(streams.Damage, match="line of more"):
        list(streams.text_blocks(iter([b"x" * 600] * 3), 100))


def test_lone_carriage_returns_do_not_end_a_line(spark, tmp_path):
    text = "one\rstill one\r\ntwo\n"
    write(tmp_path / "t" / "a.txt", text)
    (tmp_path / "a.tgz").write_bytes(tar_of({"m": text}))
    expected = ["one\rstill one", "two"]
    from_folder = [r.value for r in scan_lines(spark, str(tmp_path / "t")).collect()]
    archived = read_archives(spark, str(tmp_path / "a.tgz"))
    from_archive = [r.value for r in archived.collect()]
    assert from_folder == from_archive == expected


def test_names_with_spaces_and_repeated_rows(spark, tmp_path):
    for name in ("a b.txt", "c%20d.txt"):
        write(tmp_path / name, document([observation(TIME, 1.0)]))
    rows, found = read(spark, tmp_path)
    assert len(rows) == 2 and found.rejects.count() == 0


def test_chunked_join_gives_the_broadcast_result(spark, tmp_path, set_conf):
    many = [observation(TIME + dt.timedelta(minutes=10 * i), i) for i in range(300)]
    write(tmp_path / "hot", document(many))
    write(tmp_path / "small", document(many[:3], default=25))
    write(tmp_path / "none", document(many[:3], head=False))
    set_conf("spark.sql.files.maxPartitionBytes", "4096")
    set_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    lines = scan_lines(spark, str(tmp_path))
    layouts = spread_slices(header_slices(file_headers(lines)))
    columns = ["DTG", "LOCATION", "TX_DRYB_10"]
    measured = with_narrow(data_lines(lines))
    by_chunk = attach_by_chunk(measured, layouts, chunk_bytes=5000)
    assert by_chunk.filter(F.col("source").endswith("/hot")).select("chunk").distinct().count() > 5
    expected = slice_fields(attach_by_broadcast(measured, layouts)).select(columns)
    got = slice_fields(by_chunk).select(columns)
    assert got.count() == 303
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


@pytest.fixture()
def mixed_files(tmp_path):
    """Many files with one header, and one each with another, fewer fields, and none."""
    for i in range(12):
        write(tmp_path / f"same{i}", document([observation(TIME, float(i), T_WETB_10=i)]))
    write(tmp_path / "other", document([observation(TIME, 50.0, T_WETB_10=1)], default=27))
    few = ["DTG", "LOCATION", "TX_DRYB_10"]
    write(tmp_path / "few", document([observation(TIME, 60.0)], few))
    write(tmp_path / "none", document([observation(TIME, 99.0)], head=False))
    return tmp_path


def layout_plan(spark, path, limit):
    found = read_observations(spark, str(path), broadcast_limit=limit)
    rows = sorted((r.TX_DRYB_10, r.T_WETB_10, r.NAME) for r in found.observations.collect())
    return rows, found.observations._jdf.queryExecution().optimizedPlan().toString()


def test_the_ways_to_attach_slices_agree(spark, mixed_files, set_conf):
    set_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    set_conf("spark.sql.adaptive.enabled", "false")
    per_file = obs.layout_bytes(file_headers(scan_lines(spark, str(mixed_files)))) // 14
    all_files, plan = layout_plan(spark, mixed_files, 10**9)
    assert "Join Inner" in plan and "strategy=broadcast" in plan
    assert [r[0] for r in all_files] == [*map(float, range(12)), 50.0, 60.0]
    assert all_files[-1][1:] == (None, None) and all_files[-2][1:] == (1.0, "De Bilt")
    only_others, plan = layout_plan(spark, mixed_files, 5 * per_file)
    assert "Join LeftOuter" in plan and "strategy=broadcast" in plan
    by_chunk, plan = layout_plan(spark, mixed_files, 10)
    assert "Join Inner" in plan and "chunk" in plan and "strategy=broadcast" not in plan
    assert all_files == only_others == by_chunk


def test_ranges_of_files_are_read_apart(spark, tmp_path, set_conf):
    set_conf("spark.sql.adaptive.enabled", "false")
    for i in range(12):
        write(tmp_path / f"f{i:02}", document([observation(TIME, float(i))], default=21 + i))
    write(tmp_path / "none", document([observation(TIME, 99.0)], head=False))
    per_file = obs.layout_bytes(file_headers(scan_lines(spark, str(tmp_path)))) // 12
    found = read_observations(spark, str(tmp_path), broadcast_limit=4 * per_file)
    frame = found.observations
    assert sorted(r.TX_DRYB_10 for r in frame.collect()) == [*map(float, range(12))]
    plan = frame._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    opened = [s.metrics().apply("numFiles").value() for s in scans if "FileScan text" in s.toString()]
    # Every range was read and written by itself: nothing is left to broadcast at once.
    assert not opened and "Broadcast" not in plan.toString() and "chunk" not in plan.toString()
    assert sum("FileScan parquet" in s.toString() for s in scans) > 1


def test_each_range_opens_its_files_only_and_fits_the_limit(spark, tmp_path, set_conf, monkeypatch):
    set_conf("spark.sql.adaptive.enabled", "false")
    for i in range(40):
        write(tmp_path / f"f{i:02}", document([observation(TIME, float(i))], default=21 + i))
    limit = 4 * obs.layout_bytes(file_headers(scan_lines(spark, str(tmp_path)))) // 40
    sizes, opened, landing = [], [], obs.land_ranges

    def watched(groups):
        groups = list(groups)
        for lines, slices in groups:
            sizes.append(slices.select(F.sum(obs.row_bytes())).first()[0])
            plan = lines._jdf.queryExecution().executedPlan()
            lines.collect()
            scan = plan.collectLeaves().apply(0)
            opened.append(scan.metrics().apply("numFiles").value())
        return landing(groups)

    monkeypatch.setattr(obs, "land_ranges", watched)
    found = read_observations(spark, str(tmp_path), broadcast_limit=limit).observations
    assert sorted(r.TX_DRYB_10 for r in found.collect()) == [*map(float, range(40))]
    assert len(sizes) >= 10 and max(sizes) <= limit and sum(opened) == 40

def test_plan_does_not_grow_with_the_number_of_files(spark, tmp_path):
    def plan_size(count):
        for i in range(count):
            write(tmp_path / str(count) / f"f{i}", document([observation(TIME, i)]))
        found = read_observations(spark, str(tmp_path / str(count)))
        return len(found.observations._jdf.queryExecution().optimizedPlan().toString().split("\n"))
    assert plan_size(1) == plan_size(30)


def test_positions_count_characters_not_bytes(spark, tmp_path):
    names = ["Vlissingen", "Zürich", "Ísafjörður €", "東京"]
    rows = [observation(TIME + dt.timedelta(minutes=i), 1.5 + i, -i, name=n, U_SEA_10=i)
            for i, n in enumerate(names)]
    write(tmp_path / "a", document(rows, [FIELDS[0], "NAME", *FIELDS[1:2], *FIELDS[3:]]))
    got, _ = read(spark, tmp_path)
    assert [(r.NAME, r.TX_DRYB_10, r.TN_DRYB_10, r.U_SEA_10) for r in got] == [
        (n, 1.5 + i, -i, i) for i, n in enumerate(names)]


def test_only_needed_fields_are_cut(spark, tmp_path):
    write(tmp_path / "a", document([observation(TIME, 1.0)]))
    found = read_observations(spark, str(tmp_path))
    plan = found.observations.select("LOCATION", "TX_DRYB_10")._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert text.count("try_cast") == 1


def test_each_field_is_cut_once(spark, tmp_path):
    write(tmp_path / "a", document([observation(TIME, 1.0)]))
    found = read_observations(spark, str(tmp_path)).observations
    days = daily_extremes(found, tn="TN_DRYB_10")
    plan = days._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        assert "Join" not in line or "_start" not in line
    for field in ("DTG", "LOCATION", "TX_DRYB_10", "TN_DRYB_10"):
        assert plan.count(f"as binary), {field}_start") == 1


def test_headers_of_documents_in_a_column(spark):
    documents = spark.createDataFrame(
        [(1, "x\n# a\n# DTG one\n# DTG two\n"), (2, "# dtg\nDTG"), (3, None)], "id int, text string")
    lines = explode_lines(documents, "text", "line", "n")
    assert lines.filter("id = 1").count() == 5
    found = detect_headers(lines, "id", F.col("n"), "line").collect()
    assert [(r.id, r.header) for r in found] == [(1, "# DTG one")]


def test_slices(spark):
    heads = spark.createDataFrame([("# DTG  B    A  ",)], "header string")
    got = header_slices(heads, ["DTG", "A", "B", "C"]).first()
    assert got.starts == [1, 13, 8, None]
    assert got.lengths == [7, 3, 5, None]


def test_inventory(spark, tmp_path):
    sizes = {f"f{i}": 10 * i for i in range(1, 8)}
    for name, size in sizes.items():
        write(tmp_path / "d" / name, "x" * size)
    files = list_files(spark, str(tmp_path))
    assert summarize_files(files).first() == (7, 280)
    assert [tuple(r) for r in first_files(files).collect()] == list(sizes.items())[:5]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()


def tar_of(members, mode="w:gz"):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode=mode) as archive:
        for name, text in members.items():
            entry = tarfile.TarInfo(name)
            entry.size = len(text.encode())
            archive.addfile(entry, io.BytesIO(text.encode()))
    return buffer.getvalue()


def test_archives_of_other_compressions_and_odd_names(spark, tmp_path):
    text = {f"m{i}": document([observation(TIME, float(i))]) for i in range(3)}
    (tmp_path / "x.tar.zst").write_bytes(pa.compress(tar_of(text, "w"), codec="zstd", asbytes=True))
    (tmp_path / "y.TAR.BZ2").write_bytes(tar_of(text, "w:bz2"))
    (tmp_path / "z.tar.7").write_bytes(tar_of(text, "w"))
    (tmp_path / "named plain.tar").write_bytes(tar_of(text, "w:gz") + bytes(500))
    write(tmp_path / "notes.txt", "no archive")
    (tmp_path / "bad end.tgz").write_bytes(tar_of(text)[:-6] + b"\0\0\0\0\0\0")
    found = observations_from_lines(read_archives(spark, str(tmp_path), skip_damaged=True))
    assert found.observations.count() >= 4 * 3
    assert {(r.source.rsplit("/", 1)[1], r.reason) for r in found.rejects.collect()} == {
        ("notes.txt", "no archive"), ("bad%20end.tgz", "damaged")}


def test_archives(spark, tmp_path):
    write(tmp_path / "notes.txt", "not an archive")
    (tmp_path / "a.tgz").write_bytes(tar_of({
        "d/one": document([observation(TIME, 1.0)]),
        "../two": document([observation(TIME, 2.0)], [FIELDS[0], *FIELDS[:0:-1]], newline="\r\n"),
        "d/none": document([observation(TIME, 9.0)], head=False),
        "d/empty": "",
        "d/_kept": document([observation(TIME, 4.0)]),
    }))
    (tmp_path / "b.tar").write_bytes(tar_of({"three": document([observation(TIME, 3.0)])}, "w"))
    (tmp_path / "e.tar.xz").write_bytes(tar_of({"five": document([observation(TIME, 5.0)])}, "w:xz"))
    (tmp_path / "c.tar.gz").write_bytes(b"broken")
    with pytest.raises(Exception, match="damaged archive .*c.tar.gz"):
        read_archives(spark, str(tmp_path))
    found = observations_from_lines(read_archives(spark, str(tmp_path), skip_damaged=True))
    got = found.observations.collect()
    assert sorted(r.TX_DRYB_10 for r in got) == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert sorted((r.source.rsplit("/", 1)[1], r.reason) for r in found.rejects.collect()) == [
        ("c.tar.gz", "damaged"), ("empty", "empty"), ("none", "no header"), ("notes.txt", "no archive")]


def test_archive_that_breaks_off_fails_or_is_named(spark, tmp_path):
    texts = {f"m{i}": document([observation(TIME, float(i))]) for i in range(3)}
    whole = tar_of(texts, "w")
    (tmp_path / "a.tar").write_bytes(whole[: whole.index(b"m2") + 700])
    with pytest.raises(Exception, match="damaged archive"):
        read_archives(spark, str(tmp_path))
    found = observations_from_lines(read_archives(spark, str(tmp_path), skip_damaged=True))
    assert {r.TX_DRYB_10 for r in found.observations.collect()} >= {0.0, 1.0}
    assert "damaged" in {r.reason for r in found.rejects.collect()}


def test_lines_longer_than_a_block_and_across_blocks(spark, tmp_path, monkeypatch):
    lines = ["x" * n + "ä" for n in (3, 5000, 1, 0, 70, 4096)]
    (tmp_path / "a.tar").write_bytes(tar_of({"m": "\n".join(lines) + "\n", "n": "no end"}, "w"))
    monkeypatch.setattr(archives, "BLOCK_BYTES", 64)
    got = [(r.source[-1], r.value) for r in read_archives(spark, str(tmp_path)).collect()]
    assert got == [("m", x) for x in lines] + [("n", "no end")]


def test_union_of_sources_keeps_repeated_rows(spark, tmp_path):
    write(tmp_path / "a", document([observation(TIME, 1.0)]))
    one = read_observations(spark, str(tmp_path)).observations
    both = union_sources(one, one.select(*reversed(one.columns)))
    assert both.count() == 2 and both.distinct().count() == 1


def test_layout_size_bounds_what_is_broadcast(spark, tmp_path):
    write(tmp_path / "a", document([observation(TIME, 1.0)]))
    headers = file_headers(scan_lines(spark, str(tmp_path)))
    size = obs.layout_bytes(headers)
    assert len(str(tmp_path)) + 272 < size < 1000
    assert HEADER_TEXT not in headers.first().header
