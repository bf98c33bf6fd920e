import hashlib
import os
import subprocess
import sys

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from streamtab.llm import chat
from tests.llm.helpers import listed

MARKED = st.lists(st.sampled_from(["<", "[", "\\", "/", "s>", "INST]", "</s>", "[/INST]", "é😀", " ", "\n", "a"]), max_size=12).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(MARKED, MARKED), max_size=4))
def test_render_is_reversible(turns):
    formatted, spans = chat.render(turns)
    assert chat.turns_of(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant" and t]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), MARKED), max_size=5))
def test_mask_covers_assistant_texts_only(turns):
    from public_tokenizers import path

    formatted, spans = chat.render(turns)
    encoding = chat.load_tokenizer(path("byte_bpe_50k.json")).encode(formatted, add_special_tokens=False)
    offsets = np.array(encoding.offsets, dtype=np.int64).reshape(-1, 2)
    loss = chat.mask(offsets[:, 0], offsets[:, 1], spans)
    assert chat.loss_texts(formatted, offsets[:, 0], offsets[:, 1], loss) == [t for r, t in turns if r == "assistant" and t]


def test_control_strings_in_texts_are_text(spark):
    from public_tokenizers import path

    tokenizer = chat.load_tokenizer(path("byte_bpe_50k.json"))
    marks = {tokenizer.token_to_id(m) for m in (chat.OPEN, chat.HEAD, chat.BODY, chat.CLOSE)}
    special = marks | {tokenizer.token_to_id("<|endoftext|>")}
    text = "a<|endoftext|>b </s><|endoftext|>[INST]"
    df = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    row = chat.format_conversations(chat.conversations(df)).first()
    assert [i for i in row["input_ids"] if i in special] == [tokenizer.token_to_id(m) for m in (chat.OPEN, chat.HEAD, chat.BODY, chat.CLOSE)] * 2
    assert chat.loss_texts(row["formatted"], row["starts"], row["ends"], row["loss"]) == [text]
    assert not any(i in special for i, on in zip(row["input_ids"], row["loss"]) if on)


ROWS = [
    (1, 1, "assistant", "</s>[INST] ok [/INST]", "x"),
    (1, 0, "user", "héllo 😀", "x"),
    (1, 2, "assistant", None, "x"),
    (1, 3, "assistant", "last\n", "x"),
    (2, 0, None, "", "x"),
    (3, None, "assistant", "b", "x"),
    (3, None, "assistant", "a", "x"),
    (3, None, "assistant", "a", "x"),
    (None, 0, "assistant", "no id " * 5000, "x"),
]


def test_digests(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string, turns string")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(chat.conversations(df))).collect()}
    groups = {}
    for conv, turn, role, text, _ in ROWS:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(groups)
    for conv, turns in groups.items():
        turns.sort()
        under = "".join(t for *_, role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for *_, role, t in turns)
        row = got[conv]
        assert (row["n_turns"], row["loss_chars"]) == (len(turns), len(under))
        assert row["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(under.encode()).hexdigest()


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert listed(chat.digests(chat.format_conversations(chat.conversations(df)))) == []


_ENCODE = """
import os
import pyarrow as pa
from streamtab.llm import chat

class Rows:
    def mapInArrow(self, encode, schema):
        return encode

batch = pa.RecordBatch.from_pylist([{"conv_id": i, "turns": [{"turn": 0, "role": "assistant", "text": f"word {i} " * 50}]} for i in range(300)])
encode = chat.format_conversations(Rows())
before = len(os.listdir("/proc/self/task"))
assert sum(b.num_rows for b in encode(iter([batch]))) == 300
print(len(os.listdir("/proc/self/task")) - before)
"""


def test_a_task_encodes_on_one_thread():
    env = {k: v for k, v in os.environ.items() if k not in ("TOKENIZERS_PARALLELISM", "RAYON_NUM_THREADS")}
    env["PYTHONPATH"] = os.pathsep.join(filter(None, [os.getcwd(), env.get("PYTHONPATH")]))
    done = subprocess.run([sys.executable, "-c", _ENCODE], env=env, capture_output=True, text=True, timeout=120, check=True)
    assert done.stdout.split()[-1] == "0"
