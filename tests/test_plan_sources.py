import math

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import plan_math as pm
from corpusloom.operators.series import number_in_group
from corpusloom.plans.run_plan import run_plan
from corpusloom.session import list_folder, new_scratch, release_scratch, scratch_mark, stage_table
from corpusloom.sources import footers, images, ledger, tables
from corpusloom.sources.commits import CommitLog
from corpusloom.sources.export import _groups, export_tokens, read_tokens


def planned(spark, rows, **options):
    counts = spark.createDataFrame([(n,) for n in rows], "n_rows long")
    return run_plan(counts, **options).collect()


def test_steps_and_epochs(spark):
    few, many = planned(spark, [100, 1001], batch=2, accumulate=8, epochs=3)
    assert (few.steps_per_epoch, few.total_steps, few.epochs) == (6, 18, 3)
    assert (many.steps_per_epoch, many.total_steps) == (62, 186)
    fixed, tiny = planned(spark, [80, 3], fixed_steps=35)
    assert (fixed.total_steps, fixed.epochs) == (35, 3) and (tiny.steps_per_epoch, tiny.epochs) == (0, 35)


@pytest.mark.parametrize("steps,fraction,stop", [
    (0, 0.22, 50), (227, 0.22, 50), (232, 0.22, 51), (3999, 0.22, 879), (4000, 0.18, 720),
])
def test_floor_boundaries(spark, steps, fraction, stop):
    row = spark.createDataFrame([(steps,)], "s long").select(
        pm.floor_fraction(F.greatest("s", F.lit(1))).alias("f"), pm.min_stop_step(F.col("s")).alias("m")
    ).first()
    assert (row.f, row.m) == (fraction, stop)


@pytest.mark.parametrize("total", [0, 1, 10, 11, 137, 1000, 31623, 100_000, 10_000_000])
def test_hard_cap(spark, total):
    got = spark.createDataFrame([(total,)], "t long").select(pm.hard_cap_fraction(F.col("t"))).first()[0]
    reach = min(1.0, max(0.0, (math.log10(max(total, 10)) - 1) / 4))
    assert got == pytest.approx(0.95 - 0.30 * reach, abs=6e-5)
    assert got == round(got, 4)


def test_warmup(spark):
    rows = planned(spark, [0, 8 * 7499, 8 * 7600])
    assert [r.warmup_steps for r in rows] == [75, 75, 76]


@pytest.mark.parametrize("rows,epochs,stop,name", [
    (1499, 1, 50, "linear"), (749, 2, 50, "linear"), (750, 2, 50, "cosine"), (5000, 1, 50, "linear"),
    (1000, 2, 720, "linear"), (1000, 2, 719, "cosine"), (100_000, 2, 50, "cosine"), (0, 0, 50, "linear"),
])
def test_schedule(spark, rows, epochs, stop, name):
    df = spark.createDataFrame([(rows, epochs, stop)], "r long, e long, s long")
    assert df.select(pm.schedule_name(F.col("r"), F.col("e"), F.col("s"))).first()[0] == name


def test_the_restart_branch_never_applies(spark):
    grid = spark.range(0, 45000, 251).select(
        F.col("id").alias("r"), F.explode(F.array(*[F.lit(e) for e in (1, 2, 3, 5)])).alias("e")
    ).select("*", F.explode(F.sequence(F.lit(0), F.lit(20000), F.lit(500))).alias("s"))
    names = grid.select(pm.schedule_name(F.col("r"), F.col("e"), F.col("s")).alias("n")).distinct().collect()
    assert {r.n for r in names} == {"linear", "cosine"}


@pytest.mark.parametrize("steps,sizes", [(0, (128, 96, 42)), (10_000, (150, 112, 50)), (100_000, (1500, 1125, 500))])
def test_monitor_windows(spark, steps, sizes):
    window = pm.monitor_window(F.col("s"))
    row = spark.createDataFrame([(steps,)], "s long").select(window, pm.slope_window(window), pm.history_needed(window))
    assert tuple(row.first()) == sizes


def test_numbers_run_through_blocks(spark):
    rows = [(g, v, v * 10) for g in range(3) for v in range(0, 100, g + 1)]
    df = spark.createDataFrame(rows, "g long, v long, x long").repartition(5)
    got = number_in_group(df, "g", ["v"], [F.floor(F.col("v") / 49), F.floor(F.col("v") / 7)]).collect()
    for g in range(3):
        own = sorted((r.v, r.n, r.x) for r in got if r.g == g)
        assert own == [(v, i + 1, v * 10) for i, v in enumerate(range(0, 100, g + 1))]


def test_dataset_names(spark):
    paths = ["/a/b/set.parquet", "set", "c:\\x\\y.tar.gz", "dir/.hidden", "a..b", "/x/y/"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r[0] for r in df.select(ledger.dataset_name(F.col("p"))).collect()]
    assert got == ["set", "set", "y.tar", ".hidden", "a.", ""]


def test_ledger_appends_whole_new_names_once(spark):
    path = new_scratch(spark, "ledger")
    names = spark.createDataFrame([("ultrachat",), ("ultrachat",), ("b",)], "name string")
    assert ledger.log_datasets(spark, names, path) is True
    assert ledger.log_datasets(spark, names, path) is False
    more = spark.createDataFrame([("chat",), ("b",)], "name string")
    assert [r.name for r in ledger.new_names(more, ledger.read_ledger(spark, path)).collect()] == ["chat"]
    assert ledger.log_datasets(spark, more, path) is True
    assert sorted(r.name for r in ledger.read_ledger(spark, path).collect()) == ["b", "chat", "ultrachat"]


def test_two_writers_log_a_name_once(spark, monkeypatch):
    path = new_scratch(spark, "ledger")
    names = [spark.createDataFrame([(n,) for n in group], "name string") for group in (("a", "b"), ("b", "c"))]
    take, raced = CommitLog.take, []

    def slower(self, number, text):
        if not raced:  # another writer commits between our look at the ledger and our commit
            raced.append(1)
            assert ledger.log_datasets(spark, names[1], path) is True
        return take(self, number, text)
    monkeypatch.setattr(CommitLog, "take", slower)
    assert ledger.log_datasets(spark, names[0], path) is True
    assert sorted(r.name for r in ledger.read_ledger(spark, path).collect()) == ["a", "b", "c"]
    assert len([n for n in list_folder(spark, path) if n.startswith("_data")]) == 2


def test_a_ledger_of_plain_files_goes_on(spark):
    path = new_scratch(spark, "ledger")
    spark.createDataFrame([("old",)], "name string").write.parquet(path)
    assert ledger.log_datasets(spark, spark.createDataFrame([("old",), ("new",)], "name string"), path) is True
    assert sorted(r.name for r in ledger.read_ledger(spark, path).collect()) == ["new", "old"]
    assert ledger.log_datasets(spark, spark.createDataFrame([("old",), ("new",)], "name string"), path) is False


def test_commits_take_each_number_once(spark):
    log = CommitLog(spark, new_scratch(spark, "log") + "/_commits")
    assert log.read() == []
    assert log.take(0, "first") and not log.take(0, "second") and log.take(1, "é third")
    assert log.read() == ["first", "é third"]


def coded(spark, rows):
    return spark.createDataFrame([(i, list(range(n)), [1] * n, list(range(n)), n) for i, n in rows],
                                 "doc_id long, input_ids array<int>, attention_mask array<int>, labels array<int>, length long")


def test_a_killed_export_goes_on(spark):
    source, path = new_scratch(spark, "files"), new_scratch(spark, "tokens")
    coded(spark, [(i, i % 7) for i in range(60)]).repartition(5).write.parquet(source)
    calls = []

    def make(rows):
        calls.append(sorted(r.doc_id for r in rows.select("doc_id").collect()))
        if len(calls) == 3:
            raise InterruptedError
        return rows
    with pytest.raises(InterruptedError):
        export_tokens(spark, source, make, path, max_length=8, group_bytes=1, file_bytes=8 * 24 * 4)
    assert read_tokens(spark, path).count() == sum(map(len, calls[:2]))
    assert export_tokens(spark, source, make, path, max_length=8, group_bytes=1, file_bytes=8 * 24 * 4) == 3
    assert calls[3] == calls[2] and sorted(sum(calls[:2] + calls[3:], [])) == list(range(60))
    coded(spark, [(99, 3)]).write.mode("append").parquet(source)
    assert export_tokens(spark, source, make, path, max_length=8) == 1
    assert export_tokens(spark, source, make, path, max_length=8) == 0
    made = read_tokens(spark, path)
    assert sorted(r.doc_id for r in made.collect()) == [*range(60), 99]
    assert dict(made.dtypes)["input_ids"] == "array<bigint>" and dict(made.dtypes)["length"] == "int"
    per_file = made.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert per_file <= 4


def test_groups_of_files():
    files = [("b", 5), ("a", 4), ("c", 20), ("d", 1), ("e", 1)]
    assert _groups(files, 9) == [["a", "b"], ["c"], ["d", "e"]]
    assert _groups([], 9) == [] and _groups(files, 1) == [["a"], ["b"], ["c"], ["d"], ["e"]]


def test_scratch_is_released(spark):
    mark = scratch_mark()
    kept = [stage_table(spark.range(3), "kept"), stage_table(spark.range(4), "kept")]
    paths = [t.inputFiles()[0] for t in kept]
    assert release_scratch(spark, mark) == 2 and scratch_mark() == mark
    assert not any(list_folder(spark, p.rsplit("/", 1)[0]) for p in paths)


def test_rows_per_file_from_footers(spark):
    path = new_scratch(spark, "rows")
    spark.range(100).withColumn("text", F.lit("x" * 50)).repartition(3).write.parquet(f"{path}/a")
    spark.range(7).coalesce(1).write.parquet(f"{path}/b/c")
    spark.range(0).coalesce(1).write.parquet(f"{path}/empty")
    counted = footers.file_rows(spark, path)
    got = [(r.file.replace(path, "").split("/part")[0].split(":")[-1], r.n_rows, r.n_bytes > 0) for r in counted.collect()]
    assert sorted(g for g in got if not g[0].endswith("/a")) == [("/b/c", 7, True), ("/empty", 0, True)]
    assert sum(n for _, n, _ in got) == 107 and len(got) == 5
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_conflicts_of_types_over_files(spark):
    path = new_scratch(spark, "types")
    for i in range(9):
        kind = "string" if i == 4 else "bigint"
        df = spark.range(2).select(F.col("id").cast(kind).alias("a"), F.lit(1.0).alias("b"))
        (df.withColumn("c", F.lit(True)) if i != 7 else df).coalesce(1).write.parquet(f"{path}/{i}")
    groups = footers.file_groups(spark, sorted(r.file for r in footers.parquet_files(spark, path).collect()))
    assert sorted(len(g.files) for g in groups) == [1, 8]
    got = {(r.column, r.type): (r.n_files, r.example.split("/")[-2]) for r in footers.type_conflicts(spark, path).collect()}
    assert got == {("a", "string"): (1, "4"), ("a", "bigint"): (8, "0")}
    sound = new_scratch(spark, "types")
    spark.range(5).repartition(2).write.parquet(sound)
    assert footers.type_conflicts(spark, sound).count() == 0


PNG = bytes.fromhex("89504E470D0A1A0A") + b"rest"


def test_image_columns(spark):
    rows = [(1, PNG), (2, b"\xff\xd8\xff\xe0"), (3, b"no image"), (4, None), (5, b"")]
    plain = spark.createDataFrame([(i, None if b is None else bytearray(b)) for i, b in rows], "i int, image binary")
    assert [r.i for r in images.keep_readable(plain).collect()] == [1, 2]
    assert images.image_report(plain).collect() == [(5, 3)]
    packed = plain.select("i", F.struct(F.col("image").alias("bytes"), F.lit("p").alias("path")).alias("image"))
    assert [r.i for r in images.keep_readable(packed).collect()] == [1, 2]


@pytest.mark.parametrize("content,wanted", [
    (b"RIFF\x10\0\0\0WEBPVP8 ", True), (b"RIFF\x10\0\0\0WAVEfmt ", False), (b"GIF89a", True), (b"GIF87a", True),
    (b"GIF8", False), (b"BM of plain text", False), (b"BM\x46\0\0\0\0\0\0\0\x36\0\0\0\x28\0\0\0", True),
    (b"II*\0", True), (b"MM\0*", True),
])
def test_image_signatures(spark, content, wanted):
    one = spark.createDataFrame([(bytearray(content),)], "image binary")
    assert one.select(images.looks_like_image(F.col("image"))).first()[0] is wanted


def test_image_paths_and_decoded_images(spark):
    files = spark.createDataFrame([("a.png", bytearray(PNG)), ("b.txt", bytearray(b"text"))], "path string, content binary")
    paths = spark.createDataFrame([(1, "a.png"), (2, "b.txt"), (3, "gone.png"), (4, None)], "i int, image_path string")
    assert [r.i for r in images.keep_readable(paths, "image_path", files).collect()] == [1]
    assert images.image_report(paths, "image_path", files).collect() == [(4, 3)]
    with pytest.raises(ValueError, match="holds paths"):
        images.keep_readable(paths, "image_path")
    decoded = spark.createDataFrame(
        [(1, ("o", 2, 2, 3, 16, bytearray(b"123456789012"))), (2, ("o", -1, -1, -1, -1, bytearray(b""))), (3, None)],
        "i int, image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>")
    assert [r.i for r in images.keep_readable(decoded).collect()] == [1]
    assert images.image_report(decoded).collect() == [(3, 2)]


def test_image_paths_are_filled_by_a_join(spark):
    rows = spark.createDataFrame([(1, (None, "a.png")), (2, (bytearray(b"xx"), None)), (3, (None, "gone"))],
                                 "i int, image struct<bytes:binary,path:string>")
    files = spark.createDataFrame([("a.png", bytearray(PNG))], "path string, content binary")
    got = {r.i: r.image.bytes for r in images.resolve_paths(rows, files).collect()}
    assert bytes(got[1]) == PNG and bytes(got[2]) == b"xx" and got[3] is None


def test_image_files(spark, tmp_path):
    import struct
    import zlib

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", 1, 1, 8, 2, 0, 0, 0)
    png = PNG[:8] + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(b"\0\1\2\3")) + chunk(b"IEND", b"")
    (tmp_path / "good.png").write_bytes(png)
    (tmp_path / "bad.png").write_bytes(b"broken")
    got = images.read_images(spark, str(tmp_path)).select("image.width", "image.height").collect()
    assert got == [(1, 1)]


def test_reader_takes_parquet_only(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.read_training_table(spark, "data.csv")
    spark.range(3).write.parquet(str(tmp_path / "set.parquet"))
    assert tables.read_training_table(spark, str(tmp_path / "set.parquet")).count() == 3
    assert tables.column_names(spark, str(tmp_path / "set.parquet")) == ["id"]
