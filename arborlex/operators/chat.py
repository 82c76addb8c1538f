"""Conversation corpora (C1-C7): ``turns(conv_id, turn, role, text)``.

Rendering is done per turn (fully parallel, long form); only the final string
assembly groups by conversation, and its output is that one string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Chat markup, default system text and the refusal keyword list.
IM_START, IM_END = "<|im_start|>", "<|im_end|>"
DEFAULT_SYSTEM = "You are a helpful AI assistant named SmolLM, trained by Hugging Face"
REFUSAL_KEYWORDS = (
    "As an AI", "I don't", "I cannot", "I am not", "I won't", "I will not", "I cannot", "I do not", "I can't",
    "not to",
)
MAX_NEW_TOKENS = 128


def message_block(role: Column, text: Column) -> Column:
    return F.concat(F.lit(IM_START), role, F.lit("\n"), text, F.lit(IM_END + "\n"))


def render_pieces(turns: DataFrame, default_system: str = DEFAULT_SYSTEM) -> DataFrame:
    """C1 in long form: ``(conv_id, turn, piece)``; the first turn carries the default
    system block when it is not itself a system message."""
    w = Window.partitionBy("conv_id")
    first_turn = F.min("turn").over(w)
    default = message_block(F.lit("system"), F.lit(default_system))
    piece = F.when((F.col("turn") == first_turn) & (F.col("role") != "system"),
                   F.concat(default, message_block(F.col("role"), F.col("text")))).otherwise(
        message_block(F.col("role"), F.col("text")))
    return turns.select("conv_id", "turn", piece.alias("piece"))


def render(turns: DataFrame, default_system: str = DEFAULT_SYSTEM, add_generation_prompt: bool = True) -> DataFrame:
    """One prompt string per conversation."""
    first = F.min_by("role", "turn")
    msgs = F.array_sort(F.collect_list(F.struct("turn", message_block(F.col("role"), F.col("text")).alias("b"))))
    g = turns.groupBy("conv_id").agg(first.alias("first_role"), msgs.alias("m"))
    body = F.array_join(F.transform("m", lambda x: x["b"]), "")
    head = F.when(F.col("first_role") != "system", message_block(F.lit("system"), F.lit(default_system))).otherwise(
        F.lit(""))
    tail = F.lit(IM_START + "assistant\n") if add_generation_prompt else F.lit("")
    return g.select("conv_id", F.concat(head, body, tail).alias("prompt"))


def audit(prompts: DataFrame, turns: DataFrame) -> DataFrame:
    """Starts with a system block, holds one system block, contains every message."""
    sys_tag = IM_START + "system"
    p = prompts.select(
        "conv_id", "prompt",
        F.col("prompt").startswith(sys_tag).alias("starts_with_system"),
        ((F.length("prompt") - F.length(F.replace(F.col("prompt"), F.lit(sys_tag), F.lit("")))) / len(sys_tag) < 2)
        .alias("one_system_block"),
    )
    # one row per conversation (its messages next to its prompt): linear in the conversation,
    # where joining the prompt to every turn would copy it once per turn
    msgs = turns.groupBy("conv_id").agg(F.collect_list("text").alias("texts"))
    j = p.join(msgs, "conv_id", "left")
    contained = F.coalesce(F.forall(F.col("texts"), lambda t: F.col("prompt").contains(t)), F.lit(True))
    return j.select("conv_id", "starts_with_system", "one_system_block", contained.alias("all_contained"))


def last_reply(turns: DataFrame) -> DataFrame:
    """The content of the last message (partial aggregate, no sort)."""
    return turns.groupBy("conv_id").agg(F.max_by(F.struct("role", "text"), "turn").alias("l")).select(
        "conv_id", F.col("l.role").alias("last_role"), F.col("l.text").alias("last_text"))


def is_refusal(text: Column, keywords: tuple[str, ...] = REFUSAL_KEYWORDS) -> Column:
    """C4: any keyword, case-sensitive containment."""
    return F.exists(F.array(*[F.lit(k) for k in keywords]), lambda k: text.contains(k))


def has_keyword(text: Column, keyword: Column) -> Column:
    """Case-insensitive containment."""
    return F.lower(text).contains(F.lower(keyword))


def append_turn(turns: DataFrame, messages: DataFrame) -> DataFrame:
    """``history + [message]``: each new message gets turn = last turn + 1."""
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("_last"))
    new = messages.join(last, "conv_id", "left").select(
        "conv_id", (F.coalesce(F.col("_last"), F.lit(-1)) + 1).cast(turns.schema["turn"].dataType).alias("turn"),
        "role", "text")
    return turns.select("conv_id", "turn", "role", "text").unionByName(new)


def strip_prompt(output_ids: Column, prompt_len: Column, max_new: int = MAX_NEW_TOKENS) -> Column:
    """``outputs[len(prompt):][:max_new]``."""
    return F.slice(output_ids, prompt_len + 1, F.lit(max_new))
