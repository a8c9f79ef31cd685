"""Multi-party perspective rotation of dialogues (DataFrame functions only).

For every participant of a dialogue the dialogue is rendered with that speaker as the assistant,
the others as named users and system turns as they are, together with the spans of the rendering
that are to be learnt: the assistant's texts and the marks that end them.

A rendering comes in parts of at most ``TURNS_PER_PART`` consecutive turns, in order of ``part``,
``piece`` and ``run``; joining the parts gives the whole dialogue, and spans count characters
(code points) from the start of their part. So no dialogue, however long, has to meet in one task.

Defined cases: turns are in order of (turn, speaker, md5 of the text), a null turn first; a null
text is empty, a null speaker is the participant ``unknown``; rows with a null dialogue id form one
dialogue; repeated rows are repeated turns. A dialogue with system turns only has no perspective.
A part with more than ``LARGE_PART`` rows (many with the same turn number) is cut into pieces by turn,
speaker and leading digits of the md5, and a row with many copies into runs of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURNS_PER_PART = 64
LARGE_PART = 256  # distinct turns of a part above which it is cut into pieces
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def rotate_perspectives(turns: DataFrame, dialogue: str = "conv_id", turn: str = "turn",
                        speaker: str = "role", text: str = "text",
                        system: str = "system") -> DataFrame:
    """``dialogue``, ``assistant``, ``part``, ``piece``, ``run``, ``n_turns``, ``rendered``, ``spans``.

    ``spans`` is an array of (from_char, to_char) in ``rendered``, the end not included.
    """
    base = turns.select(
        F.col(dialogue).alias("dialogue"), F.col(turn).alias("turn"),
        F.coalesce(F.col(speaker).cast("string"), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    # equal rows combine before the shuffle, and come back as runs of copies
    rows = (base.groupBy("dialogue", "turn", "speaker", "text").agg(F.count("*").alias("copies"))
            .withColumn("digest", F.md5("text"))
            .withColumn("run", F.explode(F.expr(f"sequence(0, (copies - 1) div {TURNS_PER_PART})")))
            .withColumn("copies", F.least(F.lit(TURNS_PER_PART),
                                          F.expr(f"copies - run * {TURNS_PER_PART}")))
            .withColumn("part", F.floor(F.col("turn") / TURNS_PER_PART)))
    sizes = (rows.groupBy("dialogue", "part").agg(F.sum("copies").alias("n"), F.max("copies").alias("most"))
             .where(f"n > {LARGE_PART} OR most >= {TURNS_PER_PART}"))
    digits = F.greatest(F.lit(1), F.ceil(F.log(F.col("n") / TURNS_PER_PART) / F.log(F.lit(16.0))))
    rows = (rows.alias("r").join(sizes.alias("s"),
                                 F.col("r.dialogue").eqNullSafe(F.col("s.dialogue"))
                                 & F.col("r.part").eqNullSafe(F.col("s.part")), "left")
            .select("r.*", F.when(F.col("n").isNull(), "").otherwise(F.concat(
                F.lpad(F.coalesce(F.pmod("turn", F.lit(TURNS_PER_PART)), F.lit(0)).cast("string"), 2, "0"),
                F.lit("/"), "speaker", F.lit("/"),
                F.when(F.col("copies") + F.col("run") * TURNS_PER_PART >= TURNS_PER_PART, F.col("digest"))
                .otherwise(F.col("digest").substr(F.lit(1), digits.cast("int"))))).alias("piece")))
    parts = (rows.groupBy("dialogue", "part", "piece", "run")
             .agg(F.sort_array(F.collect_list(F.struct("turn", "speaker", "digest", "text", "copies")))
                  .alias("turns")))
    cast = base.where(F.col("speaker") != system).select("dialogue", F.col("speaker").alias("assistant")
                                                         ).distinct()
    seen = parts.alias("p").join(cast.alias("c"), F.col("p.dialogue").eqNullSafe(F.col("c.dialogue")))
    head = (f"CASE WHEN t.speaker = assistant THEN '{OPEN}assistant\\n' "
            f"WHEN t.speaker = '{system}' THEN '{OPEN}system\\n' "
            f"ELSE concat('{OPEN}user name=', t.speaker, '\\n') END")
    flat = "flatten(transform(turns, t -> array_repeat(t, cast(t.copies AS int))))"
    return (seen.select("p.dialogue", "assistant", "part", "piece", "run", F.expr(flat).alias("turns"))
            .withColumn("marks", F.expr(f"transform(turns, t -> {head})"))
            .withColumn("bodies", F.expr(f"transform(turns, t -> concat(t.text, '{CLOSE}'))"))
            .withColumn("ends", F.expr(
                "slice(aggregate(zip_with(marks, bodies, (m, b) -> char_length(m) + char_length(b)), "
                "array(0), (a, n) -> array_append(a, element_at(a, -1) + n)), 2, size(turns))"))
            .select("dialogue", "assistant", "part", "piece", "run", F.size("turns").alias("n_turns"),
                    F.expr("array_join(zip_with(marks, bodies, (m, b) -> concat(m, b)), '')")
                    .alias("rendered"),
                    F.expr("filter(transform(turns, (t, i) -> CASE WHEN t.speaker = assistant THEN "
                           "struct(ends[i] - char_length(bodies[i]) AS from_char, ends[i] AS to_char) "
                           "END), s -> s IS NOT NULL)").alias("spans")))
