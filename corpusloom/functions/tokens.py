"""Tokens of code-switched text: extraction, classes, language tags, runs, accent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import WORD_LETTERS

# --- fixed values: word lists and patterns that must be exactly these ---
SPELLED = "PTI PPP PML MQM USB SIM PIN TV CD DVD PC AI IT HR CEO CNIC NIC ID UK USA US UAE KSA PM AM GPS ATM SMS MBA BBA PhD MA BA BSc MSc LLB MBBS FM DJ VIP PTA HD UPS LED LCD WiFi OK ISI PSL".split()
SPOKEN = "NADRA FIA PIA WAPDA NASA UNESCO NATO OPEC FIFA PEMRA HEC NUST LUMS GIKI ISI PSL IPL NAB FBR KESC LESCO UET PTV SIM PIN RAM ROM USB".split()
LETTER_NAMES = {
    "A": "A", "B": "bi", "C": "si", "D": "di", "E": "i", "F": "ɛf", "G": "ʤi", "H": "Aʧ", "I": "I",
    "J": "ʤA", "K": "kA", "L": "ɛl", "M": "ɛm", "N": "ɛn", "O": "O", "P": "pi", "Q": "kju", "R": "ɑɹ",
    "S": "ɛs", "T": "ti", "U": "ju", "V": "vi", "W": "dʌbᵊlju", "X": "ɛks", "Y": "wI", "Z": "zɛd",
}
ARABIC_WORD = f"[{WORD_LETTERS}\u0750-\u077f\ufb50-\ufdff\ufe70-\ufeff\u200c]+"
TOKEN = rf"{ARABIC_WORD}|[A-Za-z][A-Za-z'’\-]*|\d+(?:[.:,]\d+)*|[^\s]"
# --- end of fixed values ---

ENGLISH = ("en", "en_acronym", "en_acronym_word", "roman_ur?", "num_en")


def tokenize(text: Column) -> Column:
    """Arabic-script words, Latin words, numbers, and any other visible character by itself."""
    return F.regexp_extract_all(text, F.lit(f"(?:{TOKEN})"), F.lit(0))


def classify_latin(token: Column, spelled: list[str] = SPELLED, spoken: list[str] = SPOKEN) -> Column:
    """``en``, ``en_acronym`` (spelled) or ``en_acronym_word`` (spoken as a word); the spelled list comes first."""
    t = F.regexp_replace(token, r"""^['".,!?;:()]+|['".,!?;:()]+$""", "")
    capitals = t.rlike("^[A-Z]{2,6}$")
    word = (F.char_length(t) >= 4) & F.regexp_replace(t, "^.|.$", "").rlike("[AEIOU]") & ~t.endswith("S")
    return F.when(t.isin(spelled), "en_acronym").when(t.isin(spoken), "en_acronym_word").when(capitals & word, "en_acronym_word").when(capitals, "en_acronym").otherwise("en")


def spell(token: Column) -> Column:
    """Names of the letters of a token."""
    names = F.create_map(*(F.lit(x) for kv in LETTER_NAMES.items() for x in kv))
    letters = F.filter(F.split(F.upper(token), ""), lambda c: c.rlike("^[A-Z]$"))
    return F.array_join(F.transform(letters, lambda c: F.element_at(names, c)), " ")


def raw_tag(token: Column) -> Column:
    """The tag that a token has by itself; numbers are settled by their neighbours."""
    return F.when(token.rlike(ARABIC_WORD.replace("\u200c", "")), "ur").when(token.rlike("[A-Za-z]"), classify_latin(token)).when(token.rlike("^[0-9]"), "num").otherwise("punct")


def tags_of(text: Column) -> Column:
    """The tokens of a text as an array of (token, tag), tagged as :func:`tag` does without a table of words.

    The languages of the tokens stand as one letter each in a string, in which a number finds its neighbours. What is used
    more than once is bound as an argument of a lambda.
    """

    def bound(x: Column, f) -> Column:
        return F.transform(F.array(x), f)[0]

    def tagged(x: Column) -> Column:
        sides, count = x["s"], lambda c: F.char_length(x["s"]) - F.char_length(F.replace(x["s"], F.lit(c), F.lit("")))
        vote = lambda c: F.when(c == "e", 1).when(c == "u", -1).otherwise(0)

        def one(t: Column, i: Column) -> Column:
            raw = F.element_at(x["r"], i + 1)
            left = F.substring(F.rtrim(F.substring(sides, F.lit(1), i), F.lit(".")), -1, 1)
            right = F.substring(F.ltrim(F.substring(sides, i + 2, F.char_length(sides)), F.lit(".")), 1, 1)
            both = vote(left) + vote(right)
            language = F.when(both > 0, "en").when(both < 0, "ur").when(count("e") > count("u"), "en").otherwise("ur")
            return F.struct(t.alias("token"), F.when(raw == "num", F.concat(F.lit("num_"), language)).otherwise(raw).alias("tag"))

        return F.transform(x["t"], one)

    side = lambda raw: F.when(raw.isin(*ENGLISH), "e").when(raw == "ur", "u").otherwise(".")
    sided = lambda x: bound(F.struct(x["t"].alias("t"), x["r"].alias("r"), F.array_join(F.transform(x["r"], side), "").alias("s")), tagged)
    return bound(tokenize(text), lambda t: bound(F.struct(t.alias("t"), F.transform(t, raw_tag).alias("r")), sided))


def tag(df: DataFrame, key: str, text: str, known: DataFrame | None = None) -> DataFrame:
    """(key, pos, token, tag): numbers take the language of the nearest words on either side, by vote, on a tie that
    of most words of the text. With ``known`` (a table of one column ``word``, lower case) Latin words that it
    does not hold are ``roman_ur?``."""
    if known is None:  # within the row, without a shuffle
        return df.select(key, F.posexplode(tags_of(F.col(text))).alias("pos", "t")).select(key, "pos", "t.token", "t.tag")
    rows = df.select(key, F.posexplode(tokenize(F.col(text))).alias("pos", "token")).withColumn("raw", raw_tag(F.col("token")))
    if known is not None:
        words = known.select(F.lower("word").alias("__w")).distinct()
        rows = rows.join(words, F.lower("token") == F.col("__w"), "left").withColumn("raw", F.when((F.col("raw") == "en") & F.col("__w").isNull(), "roman_ur?").otherwise(F.col("raw"))).drop("__w")
    by = Window.partitionBy(key).orderBy("pos")
    side = F.when(F.col("raw").isin(*ENGLISH), "en").when(F.col("raw") == "ur", "ur")
    rows = rows.withColumn("side", side)
    left = F.last("side", True).over(by.rowsBetween(Window.unboundedPreceding, -1))
    right = F.first("side", True).over(by.rowsBetween(1, Window.unboundedFollowing))
    whole = Window.partitionBy(key)
    most = F.when(F.count_if(F.col("side") == "en").over(whole) > F.count_if(F.col("side") == "ur").over(whole), "en").otherwise("ur")
    vote = lambda s: F.when(s == "en", 1).when(s == "ur", -1).otherwise(0)
    rows = rows.withColumn("__vote", vote(left) + vote(right)).withColumn("__most", most)
    language = F.when(F.col("__vote") > 0, "en").when(F.col("__vote") < 0, "ur").otherwise(F.col("__most"))
    return rows.select(key, "pos", "token", F.when(F.col("raw") == "num", F.concat(F.lit("num_"), language)).otherwise(F.col("raw")).alias("tag"))


def accent(tagged: DataFrame, key: str, share: float = 0.8) -> DataFrame:
    """``native`` where at least ``share`` of the tokens that are no punctuation are English, else ``pakistani``."""
    words = tagged.groupBy(key).agg(F.count_if(F.col("tag") != "punct").alias("n"), F.count_if(F.col("tag").isin(*ENGLISH)).alias("n_en"))
    return words.select(key, F.when((F.col("n") > 0) & (F.col("n_en") / F.col("n") >= share), "native").otherwise("pakistani").alias("accent"))


def english_runs(tagged: DataFrame, key: str) -> DataFrame:
    """(key, run, first_pos, span): stretches of English tokens, with the joining marks between them.

    A mark of ``'’-,`` joins if an English token follows directly. Gaps and islands over the position.
    """
    by = Window.partitionBy(key).orderBy("pos")
    english = F.col("tag").startswith("en") | F.col("tag").isin("roman_ur?", "num_en")
    following = F.lead("tag").over(by)
    joins = (F.col("tag") == "punct") & F.col("token").isin("'", "’", "-", ",") & (following.startswith("en") | (following == "num_en"))
    rows = tagged.withColumn("__en", english).withColumn("__joins", F.coalesce(joins, F.lit(False)))
    rows = rows.withColumn("__in", F.col("__en") | F.col("__joins"))
    # a joining mark counts only inside a run
    rows = rows.withColumn("__block", F.sum(F.when(F.col("__in"), 0).otherwise(1)).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.filter("__in").withColumn("__seen", F.sum(F.col("__en").cast("int")).over(Window.partitionBy(key, "__block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.filter("__seen > 0")
    one = F.struct("pos", "token")
    runs = rows.groupBy(key, "__block").agg(F.min("pos").alias("first_pos"), F.array_join(F.transform(F.sort_array(F.collect_list(one)), lambda x: x["token"]), " ").alias("span"))
    return runs.withColumn("run", F.row_number().over(Window.partitionBy(key).orderBy("first_pos"))).select(key, "run", "first_pos", "span")
