"""Chat formatting with typed content parts, in DataFrame functions only.

A turn's content is an array of parts (type, text, ref, tokens).  `flattened` visits the parts
in order: text stays text, an image, audio or document part becomes a placeholder, its
attachment reference is recorded and its expanded token count added.  A conversation is then one string

    <|im_start|>role\\n ... <|im_end|>\\n     for each turn

and `spans` has, in bytes, where the role and the text of each turn stand and whether the text is under the
loss mask (the assistant's turns).  `read_back` gives roles and texts of a formatted conversation.  Control strings inside texts and roles (fixed values, `CONTROLS`) are broken up by
a backslash after their first character, and backslashes are doubled: `unescaped` gives back
exactly what `escaped` was given, whatever the text.

Null texts are empty, null parts none, a null role is the empty role.  Turns go by number (null first), then role
and text; repeated rows are repeated turns.  Rows without conv_id form one conversation.  An
empty table gives an empty result.  A conversation is one row of the result, so all its turns meet
in one task; nothing else does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import pick

#: Strings that mean something to a template or tokenizer.
CONTROLS = ("<|", "<s>", "</s>", "<unk>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}

PARTS = T.ArrayType(T.StructType([
    T.StructField("type", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("ref", T.StringType()), T.StructField("tokens", T.LongType())]))


def escaped(text: Column) -> Column:
    """`text` without control strings, reversibly."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescaped(text: Column) -> Column:
    """What `escaped` was given."""
    out = text
    for c in reversed(CONTROLS):
        out = F.replace(out, F.lit(f"{c[0]}\\{c[1:]}"), F.lit(c))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def _role(role: Column) -> Column:
    """A role on one line."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def _role_back(role: Column) -> Column:
    return unescaped(F.replace(F.replace(F.replace(
        role, F.lit("\\\\"), F.lit("\\\\\x00")), F.lit("\\n"), F.lit("\n")), F.lit("\\\\\x00"), F.lit("\\\\")))


def flattened(parts: Column) -> Column:
    """Struct of a turn's content (placeholders in place), its attachments in order, and their expanded tokens."""
    parts = F.coalesce(parts, F.array().cast(PARTS))
    known = F.create_map(*[F.lit(x) for pair in PLACEHOLDER.items() for x in pair])
    content = F.array_join(F.transform(parts, lambda p: F.when(
        p["type"] == "text", escaped(F.coalesce(p["text"], F.lit("")))).otherwise(
        F.coalesce(known[p["type"]], F.concat(F.lit("<|part:"), _role(F.coalesce(p["type"], F.lit(""))), F.lit("|>"))))), "")
    others = F.filter(parts, lambda p: ~p["type"].eqNullSafe("text"))
    return F.struct(
        content.alias("content"),
        F.transform(others, lambda p, i: F.struct(i.alias("no"), p["type"].alias("type"), p["ref"].alias("ref"))).alias("attachments"),
        F.aggregate(others, F.lit(0).cast("long"), lambda n, p: n + F.coalesce(p["tokens"], F.lit(0))).alias("tokens"))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row for each conv_id of `turns` (conv_id, turn, role, parts).

    conv_id, formatted, spans (for each turn role_from, role_to, text_from, text_to as byte offsets, and loss),
    attachments (in order, with the turn's place) and expanded_tokens.
    """
    visited = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                           flattened(F.col("parts")).alias("flat"))
    rows = visited.select("conv_id", "turn", "role", _role(F.col("role")).alias("name"), F.col("flat.*"))
    name, content = (F.octet_length(c).cast("long") for c in ("name", "content"))
    fixed = len(OPEN) + len("\n") + len(CLOSE)
    # tied turns go by what was said, not by how it is escaped
    order = Window.partitionBy("conv_id").orderBy("turn", "role", unescaped(F.col("content")), "content")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    role_from = F.coalesce(F.sum(name + content + fixed).over(before), F.lit(0)) + len(OPEN)
    placed = rows.withColumns({"no": F.row_number().over(order) - 1, "role_from": role_from}).select(
        "conv_id", F.struct(
            "no", F.concat(F.lit(OPEN), "name", F.lit("\n"), "content", F.lit(CLOSE)).alias("turn"),
            F.struct("role_from", (F.col("role_from") + name).alias("role_to"),
                     (F.col("role_from") + name + 1).alias("text_from"),
                     (F.col("role_from") + name + 1 + content).alias("text_to"),
                     (F.col("role") == "assistant").alias("loss")).alias("span"),
            "attachments", "tokens").alias("t"))
    return placed.groupBy("conv_id").agg(F.array_sort(F.collect_list("t"), lambda a, b: a["no"] - b["no"]).alias("turns")).select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
        F.transform("turns", lambda t: t["span"]).alias("spans"),
        F.flatten(F.transform("turns", lambda t: F.transform(t["attachments"], lambda a: F.struct(
            t["no"].alias("turn"), a["no"].alias("no"), a["type"].alias("type"), a["ref"].alias("ref"))))).alias("attachments"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("expanded_tokens"))


def read_back(chats: DataFrame) -> DataFrame:
    """`chats` (formatted, spans) and the arrays roles and texts, unescaped, as the spans give them."""
    cut = "decode(substring(bytes, int(s.{0}_from) + 1, int(s.{0}_to - s.{0}_from)), 'UTF-8')"
    raw = chats.withColumn("bytes", F.col("formatted").cast("binary")).withColumns({
        "roles": F.expr(f"transform(spans, s -> {cut.format('role')})"),
        "texts": F.expr(f"transform(spans, s -> {cut.format('text')})")}).drop("bytes")
    return raw.withColumns({"roles": F.transform("roles", _role_back), "texts": F.transform("texts", unescaped)})


def text_parts(turns: DataFrame) -> DataFrame:
    """Turns with one text as turns of one part."""
    return pick(turns, "conv_id", "turn", "role", "text").select("conv_id", "turn", "role", F.array(F.struct(
        F.lit("text").alias("type"), F.col("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("long").alias("tokens"))).alias("parts"))


#: The contract's own conversation.
PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def chat_query(conversations: DataFrame) -> DataFrame:
    """The contract's columns for `op6_chat_formatting`, from what is read back."""
    rows = pick(conversations, "conv_id", "turn", "role", "text")
    probe = conversations.sparkSession.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    chats = read_back(format_chats(text_parts(rows.unionByName(probe))))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    read = chats.withColumn("learned", F.array_join(F.transform(
        F.filter(F.arrays_zip("spans", "texts"), lambda z: z["spans"]["loss"]), lambda z: z["texts"]), ""))
    return read.select(
        "conv_id", F.size("spans").cast("long").alias("n_turns"),
        sha(F.array_join(F.transform(F.arrays_zip("roles", "texts"), lambda z: F.concat(
            z["roles"], F.lit("\n"), z["texts"], F.lit("\n"))), "")).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), sha(F.col("learned")).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def _escaped_sql(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for c in CONTROLS:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


CHAT_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES {", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in PROBE)})
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_escaped_sql("role")}) + length({_escaped_sql("text")}) + {len(OPEN) + 1 + len(CLOSE)})::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""
