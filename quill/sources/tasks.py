"""Task readers: rows of public benchmark datasets → conversations.

A task is (source rows, to-conversation projection, grading column), all
DataFrame expressions. Conversations are
``messages ARRAY<STRUCT<role, content>>`` for string content, or
``parts ARRAY<STRUCT<type, text>>`` for an assistant answer with tool calls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quill.operators.prompts import parse_tool_calls, render_mc

# Answer letters of four-way multiple choice.
MC_LETTERS = ["A", "B", "C", "D"]


def _msg(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def task_mmlu(rows: DataFrame, subset: str = "all") -> DataFrame:
    """MMLU rows → MC conversation; ``auxiliary_train`` unwraps a nested ``train``;
    exactly 4 choices required (``valid``); subject kept."""
    if subset == "auxiliary_train":
        rows = rows.select("train.*")
    letters = F.array(*[F.lit(x) for x in MC_LETTERS])
    user = render_mc(F.col("question"), letters, F.col("choices"))
    return rows.select(
        F.array(_msg("user", user), _msg("assistant", F.element_at(letters, F.col("answer") + 1))).alias("messages"),
        "subject", letters.alias("letters"), (F.size("choices") == 4).alias("valid"))


def task_arc(rows: DataFrame) -> DataFrame:
    """ARC rows → MC conversation; the answer key must be one of the labels."""
    user = render_mc(F.col("question"), F.col("choices.label"), F.col("choices.text"))
    return rows.select(F.array(_msg("user", user), _msg("assistant", F.col("answerKey"))).alias("messages"),
                       F.col("choices.label").alias("letters"),
                       F.array_contains(F.col("choices.label"), F.col("answerKey")).alias("valid"))


def task_gsm8k(rows: DataFrame) -> DataFrame:
    """Question (string) + answer parsed into text / python / python_output parts."""
    return rows.select(F.col("question").alias("user"), parse_tool_calls(F.col("answer")).alias("assistant_parts"))


def task_humaneval(rows: DataFrame) -> DataFrame:
    """A10: prompt → user; prompt + newline + solution → assistant; entry point and tests kept."""
    full = F.concat(F.col("prompt"), F.lit("\n"), F.col("canonical_solution"))
    return rows.select(F.array(_msg("user", F.col("prompt")), _msg("assistant", full)).alias("messages"),
                       "entry_point", "test")


def read_icl_bundle(spark: SparkSession, bundle_dir: str) -> tuple[list[dict], DataFrame, dict[str, DataFrame]]:
    """Task configs (YAML, config-sized, parsed on the driver), random
    baselines (CSV → DataFrame) and each task's JSONL items (DataFrames).

    Config: first few-shot value, delimiter default ``' '``.
    """
    import yaml  # optional dependency, only for reading the bundle's config

    # through Spark's reader: the bundle may lie where only Spark can read
    lines = spark.read.option("wholetext", True).text(f"{bundle_dir}/core.yaml").collect()
    config = yaml.safe_load("\n".join(r[0] for r in lines))
    tasks = [{"label": t["label"], "task_type": t["icl_task_type"], "dataset_uri": t["dataset_uri"],
              "num_fewshot": t["num_fewshot"][0], "continuation_delimiter": t.get("continuation_delimiter", " ")}
             for t in config["icl_tasks"]]
    baselines = (spark.read.option("header", True).csv(f"{bundle_dir}/eval_meta_data.csv")
                 .select(F.col("Eval Task").alias("task"), F.col("Random baseline").cast("double").alias("baseline")))
    items = {t["label"]: spark.read.json(f"{bundle_dir}/eval_data/{t['dataset_uri']}")
             for t in tasks}
    return tasks, baselines, items
