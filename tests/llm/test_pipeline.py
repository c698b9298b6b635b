"""The pipeline against a brute-force version of its stages, on planted documents."""

import re
import zlib

import corpus_pipeline
import public_tokenizers
from planted import prose
from test_documents import base_spans, component_of, near_copy, removed, shingles
from tokenizers import Tokenizer


def planted():
    passage = prose(500, 40)
    rows = [(i, prose(i, 60 + i % 50)) for i in range(150)]
    rows += [(200 + i, near_copy(rows[i][1], i, 1 + i % 4)) for i in range(40)] + [(300 + i, rows[i][1]) for i in range(20)]
    rows += [(400 + i, prose(900 + i, 30) + " " + passage + " " + prose(950 + i, 30)) for i in range(15)]
    rows += [(500 + i, prose(700 + i, 40) + f" write to me{i}@mail.example.org or +1 (20{i}) 555-1234 from 10.1.2.{i} " + prose(800 + i, 20)) for i in range(8)]
    rows += [(600, None), (601, ""), (602, "12 34 !!"), (603, " ".join(prose(s, 300) for s in range(2000, 2012)))]
    return [(i, t, "en" if i % 7 else None, f"src{i % 3}", len(t or "")) for i, t in rows]


def masked(text):
    out, at = [], 0
    for kind, start, end in (s.split(":") for s in base_spans(text).split(",") if s):
        if int(start) >= at:
            out += [text[at : int(start)], f"<{kind}>"]
        at = max(at, int(end))
    return "".join(out) + text[at:]


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows = planted()
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    kept = [(i, t) for i, t, *_ in rows if re.search(r"[a-zA-Z]", t or "")]
    sets = {i: shingles(t, 5) for i, t in kept}
    ids = list(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    component = component_of([(min(x), max(x)) for x in links], ids)
    kept = [(i, t) for i, t in kept if component[i] == i]
    texts = dict(kept)
    cleaned = {i: new if gone else texts[i] for i, _, gone, new in removed(kept, 13)}
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, t in cleaned.items():
        own = [*encode.encode(masked(t), add_special_tokens=False).ids, 0]
        head = len(own) % 2048 or 2048
        for piece, (start, length) in enumerate([(0, head), *((s, 2048) for s in range(head, len(own), 2048))]):
            want.append((i, piece, start, length, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in own[start : start + length]))))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    bins = {}
    for r in got:
        bins[r.sequence_id] = bins.get(r.sequence_id, 0) + r.length
    assert max(bins.values()) <= 2048


def test_stages_keep_columns_and_survive_nothing(spark, tmp_path):
    frame = spark.createDataFrame(planted()[:30], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for rows in (frame, frame.filter("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, rows, str(tmp_path)).columns == frame.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, frame.filter("false"), str(tmp_path)).count() == 0
