"""The finite-state machine of chat formatting: it is in the query's plan and decides what is learned."""

import random

from pyspark.sql import functions as F

from __spark_entry__ import SMALL
from adlake.llm import chat, queries

ROWS = "conv_id long, turn long, role string, text string"


def walk(roles, template):
    state, before = template.start, []
    for role in roles:
        before.append(state)
        state = template.moves.get(state, {}).get(role, template.lost)
    return before, state


def test_states_against_a_walk(spark):
    draw = random.Random(5)
    convs = {i: [draw.choice(["system", "user", "assistant", "assistant", "user", "tool", ""]) for _ in range(draw.randint(1, 12))] for i in range(150)}
    convs |= {1000: ["user", "assistant"] * 3000, 1001: ["system", "user", "assistant"]}
    rows = [(i, k, role, f"t{k}") for i, roles in convs.items() for k, role in enumerate(roles)]
    df = spark.createDataFrame(rows, ROWS)
    for template in (chat.CHATML, chat.Template(learned_in=("asked",)), chat.Template(moves={}, finals=("open",))):
        for row in chat.chat_format(df, template).collect():
            before, last = walk(convs[row.conv_id], template)
            assert row.end_state == last and row.in_order == (last in template.finals)
            flags = [segment.loss for segment in row.segments[1::3]]
            allowed = template.learned_in or template.states()
            assert flags == [role in template.learned and state in allowed for role, state in zip(convs[row.conv_id], before, strict=True)]


def test_the_plan_of_the_query_holds_the_machine(spark):
    plan = queries.QUERIES["op8_chat_format"](spark, SMALL).select("loss_sha256")._jdf.queryExecution().optimizedPlan().toString()
    table = chat.CHATML.table()
    assert "assistant" in plan and str(table["assistant"]).replace(" ", "") in plan.replace(" ", "")
    assert "Python" not in plan and "Arrow" not in plan


def test_turns_without_ids(spark):
    df = spark.createDataFrame([(None, 0, "user", "a"), (None, 1, "assistant", "b"), (1, None, None, None)], ROWS).withColumn("states", F.lit(1))
    got = {row.conv_id: (row.in_order, row.end_state) for row in chat.chat_format(df).collect()}
    assert got == {None: (True, "answered"), 1: (False, "lost")}
