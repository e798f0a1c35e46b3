import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from landloom.llm import alignment as al
from landloom.llm.minhash import stored
from landloom.llm.queries import QUERIES, tokenizer_file

FILES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


class Plain:
    """Whole texts through the libraries, every token against every token."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer
        self.t = Tokenizer.from_file(FILES[0])
        self.t.encode_special_tokens = True
        self.s = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.back = {chr(b): b for b in printable}
        self.back |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}

    def piece(self, i):
        p = self.s.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.s.is_byte(i) else p.replace("▁", " ").encode()

    def document(self, text):
        if not text:
            return None
        raw = (" " + text).encode()
        a = [(i, bytes(self.back[c] for c in self.t.id_to_token(i))) for i in self.t.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, self.piece(i)) for i in self.s.encode(text)]
        if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            return None
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        links, k = [], 0
        for i, lo, hi in spans[0]:
            while k and spans[1][k - 1][2] > lo:
                k -= 1
            while k < len(spans[1]) and spans[1][k][2] <= lo:
                k += 1
            m = k
            while m < len(spans[1]) and spans[1][m][1] < hi:
                links.append((i, spans[1][m][0]))
                m += 1
        both = {e for *_, e in spans[0]} & {e for *_, e in spans[1]}
        groups, done = [], 0
        for e in sorted(both):
            groups.append("|".join(",".join(str(i) for i, lo, hi in side if done < hi <= e) for side in spans) if len(spans[0]) < 3000 else None)
            done = e
        if groups[0] is None:  # long texts: one walk
            groups, at = [], [0, 0]
            for e in sorted(both):
                part = []
                for n, side in enumerate(spans):
                    ids = []
                    while at[n] < len(side) and side[at[n]][2] <= e:
                        ids.append(str(side[at[n]][0]))
                        at[n] += 1
                    part.append(",".join(ids))
                groups.append("|".join(part))
        return len(a), len(b), ";".join(groups), links

    def table(self, rows):
        found = [self.document(t) for _, t in rows]
        docs = Counter(p for f in found if f for p in set(f[3]))
        most = defaultdict(int)
        for (a, _), n in docs.items():
            most[a] = max(most[a], n)
        out = []
        for (i, _), f in zip(rows, found):
            if f is None:
                out.append((i, 0, 0, 0, 0, 0, 0, ""))
            else:
                a, b, g, links = f
                out.append((i, a, b, g.count(";") + 1, len(links), sum(docs[p] == most[p[0]] for p in links), sum(docs[p] for p in links),
                            hashlib.sha256(g.encode()).hexdigest()))
        return out


def texts():
    draw = random.Random(11)
    words = ["The", "internationalisation", "it's", "naïve", "x-ray", "<|endoftext|>", "12.5", "don't!", "Größe", "東京タワー", "🙂🙂", "</s>", "привет", "á", " x", "ſt", "　"]
    gaps = [" ", " ", " ", " ", "  ", "   ", "\n", " \n ", "\t", " ", "  ", "\r\n", "\u0085 "]
    rows = ["".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randint(1, 50))) for _ in range(60)]
    return rows + [None, "", " ", "  ", "\n", " a", "a ", " a ", "▁", "ein ▁ mark", "same text", "same text", "\x00\x01 \x7f", "x" * 5000, "a  b", "e ́",
                   "".join(draw.choice(words) + draw.choice(gaps) for _ in range(9_000))]


def digest(df, laid, scores):
    sha = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return laid.join(scores, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", sha)


@pytest.mark.parametrize("sent", [1 << 20, 300, 0])
def test_against_plain_version(spark, monkeypatch, sent):
    rows = list(enumerate(texts())) + [(None, "same text"), (3, "same text")]
    docs = spark.createDataFrame([(i, t, "z", 5) for i, t in rows], "doc_id long, text string, groups string, row int")
    laid = stored(al.align(docs, *FILES), "aligned-test")
    got = [tuple(r) for r in digest(docs, laid, al.link_scores(laid, al.pair_counts(laid), sent)).collect()]
    assert sorted(got, key=repr) == sorted(Plain().table(rows), key=repr)


def test_long_texts_are_laid_out_in_parts(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(al, "PART_BYTES", 4000)
    monkeypatch.setattr(al, "REMEMBERED", 20)
    monkeypatch.setattr(al, "JOINED", 5)
    al.aligner.cache_clear()
    rows = [(i, t) for i, t in enumerate(texts())]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array([i for i, _ in rows]), pa.array([t for _, t in rows], pa.string())], ["row", "doc_id", "text"])
    plain = Plain()
    for out in al._align(*FILES)(iter([batch])):
        for r in out.to_pylist():
            want = plain.document(rows[r["row"]][1])
            if want is None:
                assert (r["n_a"], r["n_links"], r["groups"], r["pairs"]) == (0, 0, "", [])
            else:
                assert (r["n_a"], r["n_b"], r["groups"], r["n_links"]) == (want[0], want[1], want[2], len(want[3]))
                assert dict(zip(r["pairs"], r["times"])) == Counter(a << 32 | b for a, b in want[3])


def test_empty_table(spark):
    laid = stored(al.align(spark.createDataFrame([], "doc_id long, text string"), *FILES), "aligned-empty")
    assert al.link_scores(laid, al.pair_counts(laid)).count() == 0


def test_query_against_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_tokenizer_alignment"](spark, sf).collect())) == sorted(Plain().table(rows))
