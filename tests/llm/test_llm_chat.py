"""Operator 1: the template compiler, escaping, and conversations read back."""

import hashlib
import random
from collections import defaultdict

import pytest

from rotorwatch.llm import chat
from rotorwatch.llm.templates import CLOSE, OPEN, Block, Const, Print, TemplateError, compile_template, fold, parse


def text_of(source, **names):
    return "".join("<" if e is OPEN else ">" if e is CLOSE else e for e in compile_template(source)(names))


def test_template_language():
    assert text_of("a{{ x.y | upper }}{# no #}b", x={"y": "q"}) == "aQb"
    assert text_of("{% for m in xs %}{{ loop.index }}{% if m == 'a' %}A{% elif m == 'b' and not loop.first %}B{% else %}-{% endif %}{% endfor %}", xs=["a", "b", "c"]) == "1A2B3-"
    assert text_of("{% generation %}{{ 'x' + 1 }}{% endgeneration %}{{ none }}{{ true }}{{ x['k'] }}", x={}) == "<x1>true"
    assert text_of("{{ 'it\\'s\\n' + \"q\" }}{{ ('a' or 'b') }}{{ 1 + 2 }}") == "it's\nqa3"


def test_constants_are_folded():
    assert fold(parse("a{{ 'b' + 'c' }}{% if 1 == 1 %}d{% else %}{{ x }}{% endif %}e{% if false %}{{ y }}{% endif %}"), {}) == Block((Print(Const("abcde")),))


@pytest.mark.parametrize("source", ["{{ x.__class__ }}", "{{ x }}", "{{ 'a'.upper }}"])
def test_nothing_outside_is_reached(source):
    with pytest.raises(TemplateError):
        text_of(source, **({"x": object()} if "class" in source else {}))


@pytest.mark.parametrize("source", ["{% for x in y %}", "{% import os %}", "{{ f() }}", "{{ a | nofilter }}", "{{ 'a }}", "{% if x %}{% endfor %}"])
def test_bad_templates_fail_to_compile(source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_escaping_is_reversible():
    escape, unescape = chat.escaper()
    rng = random.Random(1)
    parts = ["<", "[", "/", "s>", "INST]", "\\", "<s>", "</s>", "[INST]", "[/INST]", "x", "\n"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert unescape(escape(text)) == text and not any(c in escape(text) for c in chat.CONTROLS)


def check(turns, got):
    convs = defaultdict(list)
    for conv, turn, role, text in turns:
        convs[conv].append((turn, role, text))
    assert {r["conv_id"] for r in got} == set(convs) and len(got) == len(convs)
    first = lambda v: (v is not None, v if v is not None else 0)
    word = lambda v: (v is not None, v or "")
    for r in got:
        rows = [(role or "", text or "") for _, role, text in sorted(convs[r["conv_id"]], key=lambda x: (first(x[0]), word(x[1]), word(x[2])))]
        loss = "".join(t for role, t in rows if role == "assistant")
        assert r["n_turns"] == len(rows)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in rows).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_conversations_come_back(spark, monkeypatch):
    monkeypatch.setattr(chat, "PIECE_CHARS", 50)
    turns = [
        (1, 0, "user", "hi </s>"), (1, 1, "assistant", "[INST] é😀 \\</s>"), (2, None, None, None), (2, 1, "assistant", ""), (None, 0, "system", "s"),
        (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (3, 0, "user</s>", "<s>"), *((9, k, "user" if k % 2 else "assistant", f"turn {k} " * 9) for k in range(200))]
    df = spark.createDataFrame([(*t, 1, "x") for t in turns], "conv_id long, turn long, role string, text string, piece int, begin string")
    formatted = chat.format_chats(df)
    check(turns, chat.read_chats(formatted).collect())
    pieces = formatted.where("conv_id = 9").orderBy("piece").collect()
    assert len(pieces) > 100 and [p["begin"] for p in pieces] == [sum(len(q["text"]) for q in pieces[:k]) for k in range(len(pieces))]
    assert chat.read_chats(chat.format_chats(df.limit(0))).count() == 0


def test_another_template(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    row = chat.format_chats(df, "{% for m in messages %}{{ m.role | upper }}: {% generation %}{{ m.text }}{% endgeneration %};{% endfor %}").collect()[0]
    assert row["text"] == "USER: a;ASSISTANT: b;" and [tuple(s) for s in row["loss"]] == [(6, 7), (19, 20)]
