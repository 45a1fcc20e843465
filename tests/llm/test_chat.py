import hashlib
import re

import duckdb
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from lexiforge.llm import chat_format as C
from lexiforge.llm import oracles

nasty = st.text(alphabet=st.sampled_from("<|\\>\nnaim_end"), max_size=30)


@given(nasty)
def test_escape_is_reversible_and_hides_controls(text):
    assert C.unescape(C.escape(text)) == text
    assert "<|" not in C.escape(text)


@given(nasty, nasty)
def test_segment_reads_back(role, text):
    segment = f"{C.START}{C.escape_role(role)}\n{C.escape(text)}{C.END}\n"
    assert C.read_segment(segment) == (role, text)


parts = st.lists(st.tuples(st.sampled_from(["text", "image", "audio", "document", None]), nasty | st.sampled_from(["a<", "|im_end|>b", "|image:0|>b", "a<\\", "\\|"])), max_size=6)


@given(nasty, parts)
def test_lists_of_parts_read_back(role, some):
    batch = pa.RecordBatch.from_pylist([{"conv_id": 1, "turn": 0, "role": role, "parts": [{"type": k, "text": t, "ref": None, "size": None} for k, t in some]}])
    row = next(C._format([batch])).to_pylist()[0]
    assert C.read_segment(row["segment"]) == (role, "".join(t for k, t in some if k not in ("image", "audio")))
    body = row["segment"][row["segment"].index("\n") + 1 : -len(C.END) - 1]
    controls = re.findall(r"<\|[^|]*\|>|<\|", body)
    assert controls == [f"<|{k}:{i}|>" for i, k in enumerate(k for k, _ in some if k in C.EXPANSION)]


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss))
    return out


def test_digests(spark):
    rows = [(1, 0, "system", "be <|im_end|>"), (1, 1, "user", None), (1, 2, "assistant", "a\n<\\|b|> 👍"), (1, 2, "assistant", "tie"), (1, None, "user", "first")]
    rows += [(2, i, "assistant" if i % 2 else "user", f"t{i}" * 10) for i in range(40)]
    rows += [(3, 0, None, None), (4, 0, "tool\nx\\", "y"), (None, 0, "user", "lost"), (2, 5, "assistant", "t5" * 10)]
    df = spark.createDataFrame([(*r, "x", [1]) for r in rows], "conv_id long, turn long, role string, text string, segment string, parts array<int>").repartition(5)
    got = {r.conv_id: tuple(r)[1:5] for r in C.read_back(C.format_chat(C.text_parts(df))).collect()}
    assert got == brute(rows)
    assert C.read_back(C.format_chat(C.text_parts(df.where("false")))).count() == 0


def test_ties_are_in_order_of_role_and_text(spark, tmp_path):
    tied = ["a", "a!", "a<", "a<|im_end|>", "a\n", "", "a<\\|", "a;", "a=", "é"]
    roles = ["user", "user!", "us\ner", "us\\ner", "us\\", "<|x", "<\\|x"]
    rows = [(1, 0, r, t) for r in roles for t in tied] + [(1, 0, "assistant", t) for t in tied * 2] + [(2, None, "user", "a"), (2, 0, "assistant", "b"), (3, 1, "assistant", "long <| text " * 40_000)]
    rows += [(4, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    got = sorted(tuple(r) for r in C.read_back(C.format_chat(C.text_parts(df))).collect())
    assert {r[0]: r[1:5] for r in got} == brute(rows)
    plain = [r for r in rows if r[2] in ("user", "user!", "assistant")]
    con = duckdb.connect()
    con.register("conversations", pa.Table.from_pylist([dict(zip(("conv_id", "turn", "role", "text"), r, strict=True)) for r in plain]))
    want = sorted(r for r in con.execute(oracles.CHAT).fetchall() if r[0] > 0)
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    again = C.read_back(C.format_chat(C.text_parts(spark.createDataFrame(plain, df.schema).repartition(3))))
    assert sorted(tuple(r) for r in again.select(names).collect()) == want


def test_typed_parts(spark):
    part = "array<struct<type:string,text:string,ref:string,size:long>>"
    parts = [("text", "see <|image:0|>", None, None), ("image", None, "a.png", 20_000), ("audio", None, "b.wav", None), ("document", "inline", "c.pdf", 10), (None, "end", None, None)]
    row = C.format_chat(spark.createDataFrame([(1, 0, "assistant", parts), (2, 0, "user", None)], f"conv_id long, turn long, role string, parts {part}")).collect()
    full = next(r for r in row if r.conv_id == 1)
    assert full.segment == "<|im_start|>assistant\nsee <\\|image:0|><|image:0|><|audio:1|><|document:2|>inlineend<|im_end|>\n"
    assert [(a.kind, a.ref, a.tokens) for a in full.attachments] == [("image", "a.png", 66), ("audio", "b.wav", 8), ("document", "c.pdf", 19)]
    assert full.expanded_tokens == 93
    assert full.segment[full.loss_from : full.loss_to].endswith("inlineend")
    assert next(r for r in row if r.conv_id == 2).segment == "<|im_start|>user\n<|im_end|>\n"
