"""Seeded synthetic conversations: letter counting and spelling.

Every random choice is a seeded md5 uniform of ``(field, seed + index)``, so
the output is a pure function of the index: deterministic across partition
counts, reproducible in SQL. Words come from a word-list table joined on a
drawn dense index (an equi-join, never a collect).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.plans.order import dense_index, seeded_key, seeded_uniform

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
TEST_RANDOM_SEED_OFFSET = 10_000_000
QUOTE_OPTIONS = ["", "'", '"']
USER_MSG_TEMPLATES = [
    "How many {letter} are in the word {word}",
    "How many {letter} are in {word}",
    "Count the number of {letter} in {word}",
    "How many times does {letter} appear in {word}",
    "What's the count of {letter} in {word}",
    "In the word {word}, how many {letter} are there",
    "How many letter {letter} are in the word {word}",
    "Count how many {letter} appear in {word}",
    "Tell me the number of {letter} in {word}",
    "How many occurrences of {letter} are in {word}",
    "Find the count of {letter} in {word}",
    "Can you count the {letter} letters in {word}",
    "What is the frequency of {letter} in {word}",
    "How many {letter}s are in {word}",
    "How many {letter}'s are in {word}",
    "Count all the {letter} in {word}",
    "How many times is {letter} in {word}",
    "Number of {letter} in {word}",
    "Total count of {letter} in {word}",
    "How many {letter} does {word} have",
    "How many {letter} does {word} contain",
    "What's the number of {letter} in {word}",
    "{word} has how many {letter}",
    "In {word}, count the {letter}",
    "How many {letter} appear in {word}",
    "Count the {letter} in {word}",
    "Give me the count of {letter} in {word}",
    "How many instances of {letter} in {word}",
    "Show me how many {letter} are in {word}",
    "Calculate the number of {letter} in {word}",
    "¿Cuántas {letter} hay en {word}?",
    "¿Cuántas veces aparece {letter} en {word}?",
    "Cuenta las {letter} en {word}",
    "¿Cuántas letras {letter} tiene {word}?",
    "{word}中有多少个{letter}",
    "{word}里有几个{letter}",
    "数一下{word}中的{letter}",
    "{word}这个词里有多少{letter}",
    "{word}에 {letter}가 몇 개 있나요",
    "{word}에서 {letter}의 개수는",
    "{word}에 {letter}가 몇 번 나오나요",
    "{word}라는 단어에 {letter}가 몇 개",
    "Combien de {letter} dans {word}",
    "Combien de fois {letter} apparaît dans {word}",
    "Compte les {letter} dans {word}",
    "Wie viele {letter} sind in {word}",
    "Wie oft kommt {letter} in {word} vor",
    "Zähle die {letter} in {word}",
    "{word}に{letter}は何個ありますか",
    "{word}の中に{letter}がいくつ",
    "{word}に{letter}が何回出てくる",
]
ANSWER_START = ("We are asked to find the number '%s' in the word '%s'. Let me try a manual approach first.\n\n"
                "First spell the word out:\n%s:%s\n\nThen count the occurrences of '%s':\n")
ANSWER_HIT, ANSWER_MISS = "%d:%s hit! count=%d\n", "%d:%s\n"
ANSWER_MANUAL = "\nThis gives us %d."
ANSWER_CALL = "'%s'.count('%s')"
ANSWER_END = "\n\nPython gives us %d.\n\nMy final answer is:\n\n#### %d"
# ---------------------------------------------------------------------------


def _pick(values: list[str], u: Column) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(u * len(values)) + 1).cast("int"))


def manual_count_trace(word: Column, letter: Column) -> Column:
    """One line per character, ``i:c`` or ``i:c hit! count=k`` (k = running hits)."""
    def line(i):
        ch = F.substring(word, i, 1)
        prefix = F.substring(word, 1, i)
        k = F.length(prefix) - F.length(F.replace(prefix, letter, F.lit("")))
        return F.when(ch == letter, F.format_string(ANSWER_HIT, i, ch, k)) \
            .otherwise(F.format_string(ANSWER_MISS, i, ch))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(word)), line), "")


def spell(word: Column) -> Column:
    return F.array_join(F.regexp_extract_all(word, F.lit("(?s)(.)"), 1), ",")


def spelling_bee(indices: DataFrame, words: DataFrame, split: str = "train",
                 idx: str = "idx") -> DataFrame:
    """G1: letter-counting conversations, one per index.

    ``words``: (word_idx 0..n−1, word). Output: idx, word, letter, count,
    user_msg, manual_text, python_expr, python_output, final_text.
    """
    off = 0 if split == "train" else TEST_RANDOM_SEED_OFFSET
    n_words = words.select(F.max("word_idx")).scalar() + 1
    s = (F.col(idx) + F.lit(off))
    u = lambda field: seeded_uniform(f"sb-{field}", s)
    draws = indices.select(idx, F.floor(u("word") * n_words).cast("long").alias("word_idx"),
                           u("mode").alias("u_mode"), u("letter").alias("u_letter"),
                           u("template").alias("u_t"), u("lower").alias("u_low"),
                           u("lq").alias("u_lq"), u("wq").alias("u_wq"), u("qmark").alias("u_q"))
    d = draws.join(words, "word_idx")
    w = F.col("word")
    from_word = F.substring(w, (F.floor(F.col("u_letter") * F.length(w)) + 1).cast("int"), 1)
    letter = F.when(F.col("u_mode") < 0.9, from_word).otherwise(_pick(list(LETTERS), F.col("u_letter")))
    d = d.withColumn("letter", letter)
    lt = F.col("letter")
    count = F.length(w) - F.length(F.replace(w, lt, F.lit("")))
    tmpl = _pick(USER_MSG_TEMPLATES, F.col("u_t"))
    tmpl = F.when(F.col("u_low") < 0.3, F.lower(tmpl)).otherwise(tmpl)
    lq, wq = _pick(QUOTE_OPTIONS, F.col("u_lq")), _pick(QUOTE_OPTIONS, F.col("u_wq"))
    msg = F.replace(F.replace(tmpl, F.lit("{letter}"), F.concat(lq, lt, lq)), F.lit("{word}"), F.concat(wq, w, wq))
    msg = F.when(F.col("u_q") < 0.5, F.concat(msg, F.lit("?"))).otherwise(msg)
    head = F.format_string(ANSWER_START, lt, w, w, spell(w), lt)
    manual = F.concat(head, manual_count_trace(w, lt), F.format_string(ANSWER_MANUAL, count))
    return d.select(idx, "word", "letter", count.alias("count"), msg.alias("user_msg"),
                    manual.alias("manual_text"),
                    F.format_string(ANSWER_CALL, w, lt).alias("python_expr"),
                    count.cast("string").alias("python_output"),
                    F.format_string(ANSWER_END, count, count).alias("final_text"))


def simple_spelling(indices: DataFrame, words: DataFrame, split: str = "train",
                    idx: str = "idx", seed: int = 42) -> DataFrame:
    """G2: "Spell the word" over the word list in a differently seeded order."""
    off = 0 if split == "train" else TEST_RANDOM_SEED_OFFSET
    shuffled = dense_index(words.withColumn("__k", seeded_key(seed, "word_idx")), ["__k"], out="sh_idx")
    n_words = words.select(F.max("word_idx")).scalar() + 1
    s = F.col(idx) + F.lit(off)
    draws = indices.select(idx, F.floor(seeded_uniform("ss-word", s) * n_words).cast("long").alias("sh_idx"))
    d = draws.join(shuffled.select("sh_idx", "word"), "sh_idx")
    w = F.col("word")
    return d.select(idx, "word", F.concat(F.lit("Spell the word: "), w).alias("user_msg"),
                    F.concat(w, F.lit(":"), spell(w)).alias("assistant_msg"))


def word_list_from_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Distinct lower-case ASCII words with a dense index in word order."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), 1)
    words = (df.select(F.explode(runs).alias("word")).where(F.col("word").rlike("^[a-z]+$"))
             .distinct())
    # dense index in md5(word) order (a uniform key the two-level prefix count can range-split)
    ranked = words.withColumn("__h", F.md5("word"))
    return dense_index(ranked, ["__h"], out="word_idx").drop("__h")
