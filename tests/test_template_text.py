"""Templates given as text."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftline.functions.template_text import TemplateTextError, compile_template
from weftline.functions.templates import render, segments

CHAT = [("system", " be "), ("user", "hi"), ("assistant", "yo"), ("tool", None)]


@pytest.fixture(scope="module")
def chat(spark):
    schema = "messages array<struct<role:string,content:string>>"
    return spark.createDataFrame([(CHAT,)], schema)


def shown(chat, text, **options):
    found = chat.select(segments(F.col("messages"), compile_template(text), **options).alias("s")).first().s
    return [(x.text, x.trainable) for x in found]


LOOP = "{% for message in messages %}"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("a{{ 'b\\n' }}" + LOOP + "{% endfor %}c", [("ab\n", False), ("c", False)]),
        (LOOP + "{{ message.role }};{% endfor %}", [("system;", False), ("user;", False), ("assistant;", False), ("tool;", False)]),
        (LOOP + "{{ loop.index }}{{ loop.index0 }}{% if loop.first %}!{% endif %}{% endfor %}", [("10!", False), ("21", False), ("32", False), ("43", False)]),
        (LOOP + "{% if message.role == 'assistant' %}<{% generation %}{{ message.content | upper }}{% endgeneration %}>{% endif %}{% endfor %}", [("<", False), ("YO", True), (">", False)]),
        (LOOP + "{% if message.content %}{{ message['content'] | trim }}{% else %}none{% endif %}{% endfor %}", [("be", False), ("hi", False), ("yo", False), ("none", False)]),
        (LOOP + "{% if not message.content and message.role != 'user' or message.role == 'user' %}x{% endif %}{% endfor %}", [("x", False), ("x", False)]),
        ("{{ messages[0].role ~ '/' + messages[9].content }}" + LOOP + "{% endfor %}{{ eos_token }}", [("system/", False), ("</s>", False)]),
        ("  {%- for message in messages -%}  \n x \n {%- endfor -%}\n", [("x", False)] * 4),
        (LOOP + "\n  {% if true %}\ny\n  {% endif %}\n{% endfor %}\n", [("y\n", False)] * 4),
        (LOOP + "{% if message.content == 'false' or 'false' %}t{% endif %}{% endfor %}", [("t", False)] * 4),
    ],
)
def test_language(chat, text, want):
    assert shown(chat, text) == want


def test_options(chat):
    text = "{{ bos_token }}{{ default_system }}" + LOOP + "{% endfor %}{% if add_generation_prompt %}go{% endif %}"
    assert shown(chat, text) == [("<s>", False)]
    assert shown(chat, text, default_system="sys", add_generation_prompt=True, bos="[B]") == [("[B]sys", False), ("go", False)]


def test_errors_become_codes(spark):
    text = "{% if messages[0].role == 'tool' %}{{ raise_exception('tool_first') }}{% endif %}" + LOOP + (
        "{% if message.role == 'user' %}u{% elif message.role == 'assistant' %}a{% else %}{{ raise_exception('role ' + message.role) }}{% endif %}{% endfor %}"
    )
    rows = [(1, [("user", "a"), ("assistant", "b")]), (2, [("user", "a"), ("x", "b"), ("y", "b")]), (3, [("tool", "")]), (4, [])]
    df = spark.createDataFrame(rows, "k int, messages array<struct<role:string,content:string>>")
    got = {r.k: tuple(r.r) for r in df.select("k", render(F.col("messages"), compile_template(text)).alias("r")).collect()}
    assert got == {1: ("ua", None), 2: (None, "role x"), 3: (None, "tool_first"), 4: ("", None)}


@pytest.mark.parametrize(
    "text",
    [
        "no loop", LOOP + "{% endfor %}" * 2, LOOP, LOOP + "{% endif %}{% endfor %}", "{% if x %}" + LOOP + "{% endfor %}{% endif %}",
        LOOP + "{{ message.name }}{% endfor %}", LOOP + "{{ loop.last }}{% endfor %}", LOOP + "{{ message.role | safe }}{% endfor %}",
        LOOP + "{{ unknown }}{% endfor %}", LOOP + "{{ 'a' 'b' }}{% endfor %}", LOOP + "{{ }}{% endfor %}", LOOP + "{{ f(1) }}{% endfor %}",
        "{{ message.role }}" + LOOP + "{% endfor %}", "{% set x = 1 %}" + LOOP + "{% endfor %}", LOOP + LOOP + "{% endfor %}{% endfor %}",
    ],
)
def test_other_texts_are_refused(spark, text):
    with pytest.raises(TemplateTextError):
        compile_template(text)


def test_no_python_workers(chat):
    text = LOOP + "{{ message.content | trim }}{% endfor %}"
    plan = chat.select(segments(F.col("messages"), compile_template(text)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
