"""Small byte ranges share tasks; overrepresented sequences do not meet in one task per sample."""

from seqloom.operators import qc as Q
from seqloom.sources import fasta, fastq


def test_small_ranges_share_tasks(spark, tmp_path):
    reads = [(i, "ACGTN"[: i % 5 + 1] * 9) for i in range(400)]
    path = tmp_path / "a.fastq"
    path.write_text("".join(f"@q{i} x\n{s}\n+\n{'I' * len(s)}\n" for i, s in reads))
    reader = fastq.FastqReader([str(path)], 64, False)
    tasks = reader.partitions()
    assert len(tasks) == 1 and len(fastq.ranges_of(tasks[0])) > 100
    got = fastq.read_fastq(spark, str(path), sample="s", mate=1, split_bytes=64).collect()
    assert sorted((r["read_idx"], r["seq"]) for r in got) == reads
    large = [fastq.FastqRange("a", i, i * n, (i + 1) * n) for n in (fastq.TASK_BYTES * 3 // 4,) for i in range(3)]
    assert [len(fastq.ranges_of(t)) for t in fastq.by_task([*large, fastq.FastqRange("a.gz", 0, 0, -1)])] == [1, 1, 1, 1]


def test_small_fasta_ranges_share_tasks_and_batches(spark, tmp_path):
    whole = {f"c{i}": "ACGTTGCA" * (i % 7) + "ACG" for i in range(200)}
    path = tmp_path / "a.fa"
    path.write_text("".join(f">{n}\n{s}\n" for n, s in whole.items()))
    reader = fasta.FastaReader([str(path)], 50, 10)
    tasks = reader.partitions()
    assert len(tasks) == 1 and len(fastq.ranges_of(tasks[0])) > 50
    assert len(list(reader.read(tasks[0]))) == 1  # one batch, not one for each piece
    got = {}
    for r in fasta.read_fasta_chunks(spark, str(path), chunk=10, split_bytes=50).collect():
        got.setdefault(r["rname"], {})[r["start"]] = r["seq"]
    assert {n: "".join(c[k] for k in sorted(c)) for n, c in got.items()} == whole


def test_overrepresented_keeps_a_samples_sequences_apart(spark):
    rows = [("s", "A" * (i % 4)) for i in range(40)] + [("t", None), ("t", "C"), (None, "G")]
    out = Q.overrepresented(spark.createDataFrame(rows, "sample string, seq string"), min_fraction=0.3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(sample#" in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert sorted(map(str, ((r["sample"], r["seq"], r["n"], r["fraction"]) for r in out.collect()))) == [
        str(("t", "C", 1, 0.5)), str(("t", None, 1, 0.5))
    ]
