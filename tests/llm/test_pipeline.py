import random
import re

import corpus_pipeline
from railyard.llm.common import staged

from tests.llm.conftest import prose


def test_stages_by_their_columns_and_effects(spark, tmp_path):
    rng = random.Random(8)
    passage = prose(rng, 60)
    rows = []
    for i in range(240):
        words = prose(rng, 90).split()
        if i % 6 == 0:
            words[5:5] = ["idiot", "moron", "trash", "scum"]
        rows.append((i, f"{' '.join(words)}\n{passage if i % 5 == 0 else prose(rng, 8)}", "en", f"s{i % 4}", 0))
    rows += [(500 + i, rows[1][1], "en", "s1", 0) for i in range(5)]
    rows += [(600, None, None, None, None), (601, "", None, "s0", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(240)], "doc_id bigint, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        now = staged(stage(spark, now, str(tmp_path)), name)
        seen[name] = now
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash_dedup", "mixing", "bpe"]
    for name in names[:-1]:
        assert seen[name].columns == docs.columns
    ids = {n: [r["doc_id"] for r in seen[n].collect()] for n in names}
    assert sorted(ids["toxicity"]) == sorted(r[0] for r in rows if not (r[0] < 240 and r[0] % 6 == 0))
    assert sum(passage in (r["text"] or "") for r in seen["line_dedup"].collect()) == 1
    assert sorted(ids["line_dedup"]) == sorted(ids["toxicity"])
    # Copies were emptied by the line dedup and are near-duplicates of the empty texts.
    assert len([i for i in ids["simhash_dedup"] if i >= 500]) <= 1
    size = sum(len(re.findall(r"\S+", r["text"] or "")) for r in seen["simhash_dedup"].collect())
    mixed = sum(len(re.findall(r"\S+", r["text"] or "")) for r in seen["mixing"].collect())
    assert abs(mixed - 1.5 * size) < 0.05 * size
    assert set(ids["mixing"]) <= set(ids["simhash_dedup"]) and len(ids["bpe"]) == len(ids["mixing"])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(ids["bpe"])
