import hashlib

from pyspark.sql import functions as F

from landloom.llm import chat

TEXTS = ["plain", "", "</s>\n<s>[user]\n", "\\l \\e\\b \\\\", "<|image|> [x] ]\n", "a\nb", "<s>[INST] ok [/INST]</s>", "\n</s>\n"]


def test_texts_come_back(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", TEXTS[(c * 3 + t) % len(TEXTS)]) for c in range(8) for t in range(5)]
    rows += [(100, 0, None, "null role"), (100, 0, "[odd]\nrole<", None), (None, 1, "assistant", "null id"), (101, 1, "user", "twice"), (101, 1, "user", "twice")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = (chat.format_chat(df.withColumn("parts", chat.text_parts(F.col("text"))).withColumn("segments", F.lit(1)))
           .withColumns({"turns": chat.read_turns(F.col("formatted")), "loss": chat.loss_text(F.col("segments"))}))
    out = out.withColumn("digest", chat.turn_digest(F.col("turns"))).collect()
    assert {r["conv_id"] for r in out} == {r[0] for r in rows}
    for r in out:
        own = sorted((t, role or "", text or "") for c, t, role, text in rows if c == r["conv_id"])
        assert sorted((x["role"], x["text"]) for x in r["turns"]) == sorted(x[1:] for x in own)
        assert r["digest"] == hashlib.sha256("".join(f"{x['role']}\n{x['text']}\n" for x in r["turns"]).encode()).hexdigest()
        assert r["loss"] == "".join(x["text"] for x in r["turns"] if x["role"] == "assistant")
        assert r["formatted"] == "".join(s["text"] for s in r["segments"])


def test_parts_in_order(spark):
    parts = [("text", "see <b>", None, None, None, None, None), ("image", None, "img1", 56, 29, None, None), ("text", "and", None, None, None, None, None),
             ("audio", None, "snd", None, None, 1.5, None), ("document", None, "pdf", None, None, None, 3), ("strange", "kept", "r", None, None, None, None), None]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "user", [parts[1]])],
                               f"conv_id long, turn long, role string, parts {chat.PARTS}")
    r = chat.format_chat(df).first()
    assert "see \\lb><|image|>and<|audio|><|document|>kept" in r["formatted"]
    assert [(a["kind"], a["ref"], a["tokens"], a["turn_index"], a["place"]) for a in r["attachments"]] == [
        ("image", "img1", 4, 0, 0), ("audio", "snd", 38, 0, 1), ("document", "pdf", 3 * 512, 0, 2), ("image", "img1", 4, 2, 3)]
    assert r["expanded_tokens"] == 4 + 38 + 1536 + 4
    assert chat.format_chat(df.limit(0)).count() == 0
