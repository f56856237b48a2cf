import hashlib

from pyspark.sql import functions as F

from tunelake.llm import chat_format, queries

SCHEMA = "conv_id long, turn long, role string, text string, body string"
ROWS = [
    (1, 0, "user", "a\\b <x> # \\l \\\\h </turn>\n### assistant: no", "clash"),
    (1, 1, "assistant", "\\### Assistant: </turn> ok", None),
    (1, 1, "assistant", "\\### Assistant: </turn> ok", None),
    (1, 2, "assistant", None, None),
    (2, None, None, "first", None), (2, 0, "ro: le<#\\c", "", None),
    (None, 3, "assistant", "é😀" * 3, None),
]


def _formatted(spark, rows):
    turns = spark.createDataFrame(rows, SCHEMA).select("conv_id", "turn", "role", "text")
    flat = chat_format.flatten_parts(turns.withColumn("parts", chat_format.text_part(F.col("text"))))
    return chat_format.format_conversations(flat)


def test_reading_back_is_exact(spark):
    back = {r.conv_id: r for r in chat_format.read_back(_formatted(spark, ROWS)).collect()}
    for conv in (1, 2, None):
        given = sorted(
            ((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in ROWS if r[0] == conv),
        )
        assert [(t.role, t.text) for t in back[conv].turns] == [(g[2], g[3]) for g in given]
        assert "".join(back[conv].loss_texts) == "".join(g[3] for g in given if g[2] == "assistant")
        assert back[conv].n_turns == len(given)


def test_mask_points_at_the_loss_in_code_points(spark):
    for row in _formatted(spark, ROWS).collect():
        for entry in row["mask"]:
            covered = row.formatted[entry.loss_start:entry.loss_start + entry.loss_chars]
            assert "</turn>" not in covered and "###" not in covered
            assert row.formatted[entry.turn_start:].startswith("### ")


def test_parts_become_ordered_placeholders(spark):
    parts = [
        ("text", "see <image:9>", None, None, None, None, None), ("image", None, "s3://i", 1024, 600, None, None),
        None, ("audio", None, "s3://a", None, None, 1.5, None), ("hologram", None, "h", None, None, None, None),
    ]
    more = [("document", None, None, None, None, None, 3), (None, "end", None, None, None, None, None)]
    turns = spark.createDataFrame(
        [(1, 1, "assistant", more), (1, 0, "user", parts), (1, 2, "user", None)],
        f"conv_id long, turn long, role string, parts {chat_format.PART_TYPE}",
    )
    row = chat_format.read_back(chat_format.format_conversations(chat_format.flatten_parts(turns))).first()
    assert [t.text for t in row.turns] == ["see <image:9><image:1><audio:2><hologram:3>", "<document:4>end", ""]
    assert "\\limage:9>" in row.formatted
    assert [tuple(a) for a in row.attachments] == [
        (1, "image", "s3://i", 85 + 170 * 4), (2, "audio", "s3://a", 38), (3, "hologram", "h", 0),
        (4, "document", None, 1800),
    ]
    assert row.expanded_tokens == 85 + 680 + 38 + 1800


def test_empty_table(spark):
    assert _formatted(spark, []).count() == 0


def test_digests(spark):
    row = next(r for r in queries.digests(_formatted(spark, ROWS)).collect() if r.conv_id is None)
    assert row.turns_sha256 == hashlib.sha256(("assistant\n" + "é😀" * 3 + "\n").encode()).hexdigest()
    assert (row.n_turns, row.loss_chars) == (1, 6)


def test_only_column_functions(spark):
    plan = _formatted(spark, ROWS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
