"""Reply trees to formatted conversations (native).

A message names its parent; a conversation is a root-to-leaf path. Paths come
from iterative self-joins that double the jump length every round, so a thread
of a thousand turns takes ten joins on narrow rows (tree, node), not a thousand.
The same rounds add up depth and score, by which the branches of a tree are
ranked. Texts are joined in only once the paths are chosen, and every path
becomes one formatted conversation.

The template is ``<s>role[INST]text</s>`` for every turn. ``&``, ``<`` and
``[`` inside roles and texts are written ``&amp;``, ``&lt;`` and ``&lsqb;``, so
no text can hold a control string and the output can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm.common import cut, table

OPEN, HEAD, CLOSE = "<s>", "[INST]", "</s>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))
NODE = "tree bigint, node bigint"


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def paths(messages: DataFrame, top: int | None = None) -> DataFrame:
    """``messages(tree, node, parent, score)`` to ``(tree, leaf, branch, node, turn)``.

    One row for each message of each chosen root-to-leaf path; ``turn`` counts
    from 0 at the root, ``branch`` ranks the leaves of a tree from 1 by mean
    score (ties: smaller leaf first), and ``top`` keeps the best branches (None:
    all). (tree, node) is unique. A parent that isn't in the tree makes its
    message a root; messages on a cycle, or under one, have no path and are left
    out; a NULL score counts as 0; a NULL tree is a tree of its own.
    """
    known = messages.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    step = cut(messages.join(known, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("p")), "left")
               .select("tree", "node", F.col("p").alias("jump"), F.lit(1).cast("bigint").alias("depth"),
                       F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("sum")))
    jumps, rows, done, going = [], step.count(), step.where("jump is null"), step.where("jump is not null")
    while len(jumps) <= max(rows, 1).bit_length() and not going.isEmpty():
        jumps.append(going.select("tree", "node", "jump"))
        # only messages that haven't reached their root are joined again
        on = done.union(going).toDF("t", "n", "next", "more", "plus")
        step = cut(going.join(on, F.col("tree").eqNullSafe(F.col("t")) & (F.col("jump") == F.col("n")))
                   .select("tree", "node", F.col("next").alias("jump"), (F.col("depth") + F.col("more")).alias("depth"),
                           (F.col("sum") + F.col("plus")).alias("sum")))
        done, going = done.union(step.where("jump is null")), step.where("jump is not null")
    inner = messages.where("parent is not null").select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    leaves = done.join(inner, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("p")), "left_anti")
    if top is None:
        ranked = leaves.withColumn("branch", F.lit(None).cast("int"))
    else:
        best = Window.partitionBy("tree").orderBy(F.desc(F.col("sum") / F.col("depth")), "node")
        ranked = leaves.withColumn("branch", F.row_number().over(best)).where(F.col("branch") <= top)
    reached = cut(ranked.select("tree", F.col("node").alias("leaf"), "branch", "depth", "node", F.lit(0).cast("bigint").alias("back")))
    for k in reversed(range(len(jumps))):
        hop = jumps[k].toDF("t", "n", "jump")
        further = reached.join(hop, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))) \
            .select("tree", "leaf", "branch", "depth", F.col("jump").alias("node"), (F.col("back") + 2 ** k).alias("back"))
        reached = cut(reached.union(further)) if k % 3 == 0 else reached.union(further)
    return reached.select("tree", "leaf", "branch", "node", (F.col("depth") - 1 - F.col("back")).alias("turn"))


def formatted(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """``turns(tree, leaf, turn, role, text)`` to one row a path: ``(tree, leaf, formatted, mask)``.

    ``mask`` lists the (start, chars) spans of the texts of role ``trained`` in
    ``formatted``, from 0, in order. NULL roles and texts are empty.
    """
    head = F.concat(F.lit(OPEN), escaped(F.coalesce(F.col("role"), F.lit(""))), F.lit(HEAD))
    body = escaped(F.coalesce(F.col("text"), F.lit("")))
    in_path = Window.partitionBy("tree", "leaf").orderBy("turn")
    rows = turns.select("tree", "leaf", "turn", F.col("role").eqNullSafe(trained).alias("learn"), head.alias("head"), body.alias("body"))
    rows = rows.withColumn("size", F.char_length("head") + F.char_length("body") + len(CLOSE))
    rows = rows.withColumn("start", F.sum("size").over(in_path) - F.col("size") + F.char_length("head"))
    rows = rows.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(F.struct(
        "turn", "learn", "start", F.concat("head", "body", F.lit(CLOSE)).alias("piece"), F.char_length("body").alias("chars")))).alias("all"))
    return rows.select("tree", "leaf", F.array_join(F.transform("all", lambda x: x["piece"]), "").alias("formatted"),
                       F.transform(F.filter("all", lambda x: x["learn"]), lambda x: F.struct(
                           x["start"].alias("start"), x["chars"].cast("bigint").alias("chars"))).alias("mask"))


def read_back(chats: DataFrame) -> DataFrame:
    """Adds ``turns`` (array of role, text) and ``learned`` (text under the mask), both from ``formatted``."""
    pieces = F.split("formatted", CLOSE)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(p):
        parts = F.split(F.substring(p, len(OPEN) + 1, 2 ** 31 - 1), r"\[INST\]")
        return F.struct(unescaped(F.get(parts, F.lit(0))).alias("role"), unescaped(F.get(parts, F.lit(1))).alias("text"))

    def span(m):
        return unescaped(F.substr(F.col("formatted"), (m["start"] + 1).cast("int"), m["chars"].cast("int")))
    return chats.withColumn("turns", F.transform(pieces, turn)) \
        .withColumn("learned", F.array_join(F.transform("mask", span), ""))


PROBE = "</s>[INST] ok [/INST]"


def op10(spark, sf_dir: str) -> DataFrame:
    """Every conversation (rows by turn) and conversation -7, formatted and read back.

    Rows of one turn number follow each other by role and text; repeated rows
    are turns of their own; rows without conv_id form one conversation.
    """
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", F.coalesce("text", F.lit("")).alias("text"))
    probe = spark.sql(f"SELECT -7L AS conv_id, turn, role, '{PROBE}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    said = rows.union(probe).select(F.col("conv_id").alias("tree"), F.row_number().over(order).cast("bigint").alias("node"), "role", "text")
    links = cut(said.select("tree", "node", (F.col("node") - 1).alias("parent"), F.char_length("text").alias("score")))
    chosen = paths(links, top=1)
    where = F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))
    turns = chosen.join(said.toDF("t", "n", "role", "text"), where).select("tree", "leaf", "turn", "role", "text")
    chats = read_back(formatted(turns))
    lines = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return chats.select(F.col("tree").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"),
                        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
                        F.char_length("learned").cast("bigint").alias("loss_chars"),
                        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
                        F.char_length("formatted").cast("bigint").alias("formatted_chars"))


OP10_SQL = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}')
), sized AS (
  SELECT *, 13 + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'))
              + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;')) AS chars FROM said
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
