"""Cases with known results: each is computed in Spark and compared with the rows that must come out."""

import unicodedata
from collections.abc import Callable

import pytest
from helpers import rows_of, rows_of_sql
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

import duckdb
from corpusloom.functions import chunks, edit, numbers, pcer, phones, rules, text, tokens
from corpusloom.functions.text import letters_only
from corpusloom.operators import admission, frontend, lexicon
from corpusloom.plans.formats import folder
from corpusloom.plans.language import values
from corpusloom.sources import files

QUERIES, ORACLES = {}, {}


def query(sql):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def golden(name: str, kind: str, cases: list[tuple], f: Callable[..., Column], decomposed: bool = False) -> None:
    """A query that computes ``f`` on literal inputs (all but the last of each case), and the expected outputs as SQL.

    ``decomposed``: outputs are in phone space, where marks are separate characters (NFD).
    """
    if decomposed:
        cases = [(*c[:-1], unicodedata.normalize("NFD", c[-1])) for c in cases]
    n = len(cases[0]) - 1
    cols = [f"x{i}" for i in range(n)]

    def run(spark: SparkSession, sf_dir: str):
        rows = spark.createDataFrame([(i, *c[:n]) for i, c in enumerate(cases)], f"id int, {', '.join(f'{c} {k}' for c, k in zip(cols, kind.split(), strict=True))}")
        return rows.select("id", f(*map(F.col, cols)).alias("result"))

    run.__name__ = name
    QUERIES[name] = run
    ORACLES[name] = values([(i, c[n]) for i, c in enumerate(cases)], "id, result")


golden("cardinal_golden", "long", [
    (0, "صفر"), (1, "ایک"), (7, "سات"), (11, "گیارہ"), (19, "انیس"), (20, "بیس"), (25, "پچیس"), (38, "اڑتیس"), (45, "پینتالیس"),
    (47, "سینتالیس"), (59, "انسٹھ"), (70, "ستر"), (89, "نواسی"), (99, "ننانوے"), (100, "ایک سو"), (101, "ایک سو ایک"), (250, "دو سو پچاس"),
    (999, "نو سو ننانوے"), (1000, "ایک ہزار"), (2500, "دو ہزار پانچ سو"), (2026, "دو ہزار چھبیس"), (100000, "ایک لاکھ"), (2500000, "پچیس لاکھ"),
    (10000000, "ایک کروڑ"), (1000000000, "ایک ارب"), (-5, "منفی پانچ"),
], numbers.cardinal)


golden("year_golden", "long", [(1947, "انیس سو سینتالیس"), (2026, "دو ہزار چھبیس"), (1999, "انیس سو ننانوے")], numbers.year)


golden("decimal_golden", "string", [("38.5", "اڑتیس اعشاریہ پانچ"), ("3.14", "تین اعشاریہ ایک چار"), ("-2.5", "منفی دو اعشاریہ پانچ")], numbers.decimal)


golden("time_golden", "int int", [(7, 45, "پونے آٹھ"), (3, 0, "تین بجے"), (4, 30, "ساڑھے چار"), (1, 30, "ڈیڑھ"), (10, 7, "دس بج کر سات منٹ")], numbers.clock)


golden("ordinal_golden", "long", [(1, "پہلا"), (5, "پانچواں"), (12, "بارہواں")], numbers.ordinal)


golden("digits_golden", "string", [("۲۰۲۶", "2026"), ("٠١٢", "012")], numbers.ascii_digits)


golden("thousands_golden", "string", [("2,500,000", "2500000")], numbers.strip_thousands)


golden("normalize_chars_golden", "string", [("كتاب يه", "کتاب یہ"), ("ه", "ہ"), ("بھائی", "بھائی"), ("کتـــاب", "کتاب")], text.normalize_chars)


golden("normalize_golden", "string", [
    ("اس کی قیمت ۲۵۰۰ روپے ہے۔", "اس کی قیمت دو ہزار پانچ سو روپے ہے۔"), ("میری سالگرہ 14 اگست کو ہوتی ہے۔", "میری سالگرہ چودہ اگست کو ہوتی ہے۔"),
    ("ٹرین صبح ۷:۴۵ پر روانہ ہوئی۔", "ٹرین صبح پونے آٹھ پر روانہ ہوئی۔"), ("۱۹۴۷ء میں پاکستان آزاد ہوا۔", "انیس سو سینتالیس میں پاکستان آزاد ہوا۔"),
    ("درجۂ حرارت ۳۸ اعشاریہ ۵ ڈگری تھا۔", "درجۂ حرارت اڑتیس اعشاریہ پانچ ڈگری تھا۔"), ("۲۰۲۶ میں 25 لوگ", "دو ہزار چھبیس میں پچیس لوگ"),
    ("50% لوگ", "پچاس فیصد لوگ"), ("Rs. 500 کا بل", "پانچ سو روپے کا بل"), ("14/08/2026 کو", "چودہ اگست دو ہزار چھبیس کو"),
], text.normalize)


golden("english_numbers_golden", "string", [("یہ meeting 3 pm پر ہے", "یہ meeting 3 pm پر ہے"), ("call me at 5 pm", "call me at 5 pm")], text.expand_numbers)


golden("sentence_split_golden", "string", [("پہلا جملہ۔ دوسرا جملہ؟ تیسرا!", "پہلا جملہ۔#دوسرا جملہ؟#تیسرا!")], lambda s: F.array_join(text.split_sentences(s), "#"))


golden("punctuation_map", "string", [("ہاں، ٹھیک ہے۔ کیا؟", "ہاں, ٹھیک ہے. کیا?")], text.normalize_punctuation)


golden("scoring_normalize_golden", "string string", [("كتاب، ۲۵!", "کتاب 25", True), ("وزیرِ اعظم", "وزیر اعظم", True), ("ہاں", "نہیں", False)], lambda a, b: text.scoring_normalize(a) == text.scoring_normalize(b))


golden("symbols_golden", "string", [("$ 20", "20 ڈالر"), ("a & b", "a اور b"), ("see www.site.org/x now", "see site dot org slash x now")], text.expand_symbols)


golden("phoneset_map_golden", "string", [
    ("pɑːkɪst̪ɑːn", "pɑːkɪstɑːn"), ("ɡʱəɾ", "ɡʰər"), ("t͡ʃʰoːʈɑː", "ʧʰoːʈɑː"), ("d͡ʒɑːnɑː", "ʤɑːnɑː"), ("nəɦĩː", "nəhĩː"), ("xuːbʂuːrat", "xuːbsuːrət"),
    ("ʋəzireː aːʐəm", "ʋəzireː ɑːzəm"), ("pʌr.hi", "pərhi"), ("mẽː", "mẽː"), ("gʰər", "ɡʰər"), ("mːəhəbbət", "mməhəbbət"), ("ãː", "ɑ̃ː"), ("ä", "ɑ"), ("ō", "oː"),
], phones.canonical, decomposed=True)


golden("split_units_golden", "string", [("bʰɑːiː", "bʰ ɑː iː"), ("nəhĩː", "n ə h ĩː"), ("ʧʰoːʈɑː", "ʧʰ oː ʈ ɑː")], lambda s: F.array_join(phones.units(s), " "), decomposed=True)


golden("accent_map_golden", "string boolean", [("lˈæptˌɑp", True, "lɛːpʈɑːp"), ("θˈɪn", True, "tʰɪn"), ("ðˈɪs", True, "dɪs"), ("wˈɔTəɹ", True, "ʋɔːʈər"), ("lˈæptˌɑp", False, "lɛːptɑːp")], lambda s, r: F.when(r, phones.to_pakistani(s)).otherwise(phones.to_pakistani(s, retroflex=False)))


golden("native_accent_golden", "string", [("ˈAʒə", "ˈAʒə")], phones.to_native)


golden("spell_letters", "string", [("USB", "ju ɛs bi")], tokens.spell)


golden("classify_latin_golden", "string", [("USB", "en_acronym"), ("NADRA", "en_acronym_word"), ("PTI", "en_acronym"), ("laptop", "en"), ("SIM", "en_acronym"), ("RADAR", "en_acronym_word"), ("BBCS", "en_acronym")], tokens.classify_latin)


golden("skeleton_golden", "string string", [
    ("لڑکی", "ləɽkiː", True), ("لڑکی", "lərkiː", False), ("گھر", "ɡʰər", True), ("گھر", "ɡər", False), ("محبت", "mʊhəbbət", True), ("آنسو", "ɑ̃ːsuː", True),
    ("پاکستان", "pɑːkɪstɑːn", True), ("پاکستان", "bɑːkɪstɑːn", False), ("بچھو", "bɪʧʧʰuː", True), ("اتفاقاً", "ɪttɪfɑːqən", True),
], phones.skeleton_ok)


golden("rules_g2p_golden", "string", [("دوست", "doːst"), ("لڑکی", "ləɽkiː"), ("ہاں", "hɑ̃ː"), ("دیوار", "diːʋɑːr"), ("لوگوں", "loːɡõː"), ("کمرہ", "kəmrɑː"), ("خواب", "xɑːb"), ("شروع", "ʃəroː"), ("جَلْد", "ʤəld"), ("شاعر", "ʃɑːər")], rules.rules_phones, decomposed=True)


golden("rules_skeleton_golden", "string", [(w, True) for w in "پاکستان لڑکی کتابیں دوست ہاں سڑک ٹھیک خواب دیوار زندگی".split()], lambda w: phones.skeleton_ok(w, rules.rules_phones(w)) & (F.size(phones.unknown_symbols(rules.rules_phones(w))) == 0))


golden("collapse_golden", "string", [("ʈʰiːk", "t i k"), ("vɛ", "ʋ e"), ("Aɹ", "e ɪ r")], lambda s: F.array_join(phones.collapse(s), " "))


golden("cer_wer_golden", "string string", [("please share the file now", "please share a file now", 0.2), ("one two", "one two", 0.0)], lambda a, b: edit.wer(edit.normalize_en(a), edit.normalize_en(b)))


golden("vocab_ids_golden", "string", [("pɑːn", "0,58,69,158,56,0"), ("一b", "0,44,0")], lambda s: F.array_join(phones.framed_ids(s).cast("array<string>"), ","))


golden("code_swap_golden", "string", [("یہ فائل دیکھو", "یہ file دیکھو"), ("ڈاکٹر؟", "doctor؟"), ("یہ نہیں", None)], lambda s: text.code_swap(s, s))


golden("fill_lines_golden", "string", [("ab cd, ef. gh", "ab cd,#ef. gh"), ("abcdefghijkl", "abcdefgh#ijkl"), ("ab", "ab")], lambda s: F.array_join(chunks.fill_lines(s, 8), "#"))


golden("align_golden", "string string", [("a b c", "a c", "M D M"), ("a", "b c", "I S"), ("a b", "b a", "S S"), ("", "x", "I")], lambda a, b: F.array_join(F.transform(edit.alignment(edit.words_of(a), edit.words_of(b)), lambda x: x["op"]), " "))


@query(values([(0, "ur ur en ur ur ur ur punct"), (1, "en ur en ur ur en ur ur punct"), (2, "ur en_acronym ur en en ur en ur ur punct"), (3, "ur en num_en en ur en ur ur ur punct")], "id, tags"))
def token_tags_golden(spark, sf_dir):
    rows = ["آج کی meeting کینسل ہو گئی ہے۔", "Please اپنا password کسی کو share نہ کریں۔", "ہمیں AI اور machine learning پر focus کرنا چاہیے۔", "یہ meeting 3 pm پر Zoom پر ہو گی۔"]
    df = tokens.tag(spark.createDataFrame(list(enumerate(rows)), "id int, text string"), "id", "text")
    return df.groupBy("id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "tag"))), lambda x: x["tag"]), " ").alias("tags"))


@query(values([(0, 1, "call me 5 pm"), (1, 1, "laptop"), (1, 2, "wifi - fi")], "id, run, span"))
def english_runs_golden(spark, sf_dir):
    df = spark.createDataFrame([(0, "آپ call me 5 pm کریں"), (1, "میرا laptop , اور wifi - fi ۔")], "id int, text string")
    return tokens.english_runs(tokens.tag(df, "id", "text"), "id").select("id", "run", "span")


_LEX = [(1, "کتاب", "kɪtɑːb"), (2, "عِلْم", "ɪlm"), (3, "وزیر", "ʋəziːr"), (4, "نامہ", "nɑːmɑː"), (5, "کِیا", "kɪjɑː"), (6, "کیا", "kjɑː"), (7, "راستی", "rɑːstiː")]


@query(values([("کتاب", "kɪtɑːb"), ("کِتاب", "kɪtɑːb"), ("علم", "ɪlm"), ("کِیا", "kɪjɑː"), ("کَیا", "kjɑː"), ("راستے", "rɑːstiː"), ("قلم", None)], "word, pron"))
def lexicon_lookup_chain(spark, sf_dir):
    words = spark.createDataFrame([(w,) for w in ("کتاب", "کِتاب", "علم", "کِیا", "کَیا", "راستے", "قلم")], "word string")
    return lexicon.lookup(words, spark.createDataFrame(_LEX, "seq int, word string, pron string")).select("word", "pron")


@query(values([("کتابِ", "kɪtɑːbeː", "lexicon"), ("وزیرِ", "ʋəziːreː", "lexicon"), ("نامۂ", "nɑːmɑːeː", "lexicon"), ("کِیا", "kɪjɑː", "lexicon"), ("ق", "qɑːf", "letter"), ("قلم", None, "rules")], "word, pron, source"))
def g2p_cascade_golden(spark, sf_dir):
    words = spark.createDataFrame([(w,) for w in ("کتابِ", "وزیرِ", "نامۂ", "کِیا", "ق", "قلم")], "word string")
    letters = spark.createDataFrame([("ق", "qɑːf"), ("غ", "ɣɛːn")], "letter string, name string")
    return lexicon.cascade(words, spark.createDataFrame(_LEX, "seq int, word string, pron string"), letters)


@query(values([("لڑکی", "ləɽkiː", "lərkiː"), ("گھر", "ɡʰər", "ɡər")], "word, best, others"))
def choose_variant(spark, sf_dir):
    df = spark.createDataFrame([("لڑکی", ["lərkiː", "ləɽkiː"]), ("گھر", ["ɡ ə r", "ɡʱ ə ɾ"])], "word string, prons array<string>")
    return lexicon.choose_variant(df, "word", "prons").select("word", "best", F.array_join("others", ",").alias("others"))


@query(values([("گھر", "ɡʰər", "agree"), ("لڑکی", "ləɽkiː", "llm"), ("پاکستان", "pɑːkɪstɑːn", "espeak"), ("محبت", "mʊhəbbət", "llm"), ("قلم", "x", "espeak"), ("دوست", "doːst", "rules")], "word, pron, source"))
def candidate_select(spark, sf_dir):
    rows = [("گھر", "ɡʰər", "ɡʰər", ""), ("لڑکی", "lɪɽkiː", "ləɽkiː", ""), ("پاکستان", "pɑːkɪstɑːn", "bɑːn", ""), ("محبت", "bət", "mʊhəbbət", ""), ("قلم", "x", "", ""), ("دوست", "", "", "doːst")]
    return lexicon.select_candidate(spark.createDataFrame(rows, "word string, a string, b string, r string"), rules=F.col("r"))


@query(values([("گھر", "ɡʰər", "neural"), ("لڑکی", "ləɽkiː", "rules"), ("دوست", "doːst", "rules")], "word, pron, source"))
def rerank_select(spark, sf_dir):
    rows = [("گھر", [("ɡʰər", -0.3), ("ɡər", -0.1)], "ɡʰɪr"), ("لڑکی", [("lərkiː", -0.1)], "ləɽkiː"), ("دوست", [("doːst", -9.0)], "doːst")]
    return lexicon.rerank(spark.createDataFrame(rows, "word string, cands array<struct<pron:string,logp:double>>, rules string"))


@query(values([(0.0, 0.0, 0.0, "", 4), (2 / 7, 1 / 3, 0.25, "", 7), (4 / 7, 1 / 3, 0.75, "email", 7)], "pcer, pcer_ur, pcer_en, lost, n_ref"))
def pcer_golden(spark, sf_dir):
    w = "array<struct<word:string,lang:string,phones:array<string>>>"
    rows = [([("کام", "ur", list("kɑm")), ("a", "en", ["ə"])], list("kɑmə")), ([("کام", "ur", list("kɑm")), ("email", "en", list("imel"))], list("kɑmel"))]
    rows.append((rows[1][0], list("kɑm")))
    df = spark.createDataFrame(rows, f"ref {w}, hyp array<string>").select(pcer.pcer(F.col("ref"), F.col("hyp")).alias("r"))
    return df.select("r.pcer", "r.pcer_ur", "r.pcer_en", F.array_join("r.lost", ",").alias("lost"), "r.n_ref")


ENTRIES = [(1, "کتاب", "kɪtɑːb"), (2, "یہ", "jeː"), (3, "ہے", "hɛː"), (4, "کِیا", "kɪjɑː"), (5, "کْیا", "kjɑː"), (6, "آپ", "ɑːp"), (7, "نے", "neː"), (8, "کام", "kɑːm"), (9, "اچھی", "əʧʧʰiː")]


ENGLISH = [("laptop", "lˈæptˌɑp"), ("good", "ɡˈʊd"), ("Nadra", "nˈɑdɹə"), ("this", "ðˈɪs"), ("is", "ɪz")]


SENTENCES = [(0, "یہ laptop ہے۔"), (1, "کْیا آپ نے کام کِیا؟"), (2, "this is good."), (3, "یہ USB ہے!"), (4, "یہ NADRA، کتاب ہے"), (5, "یہ gadget ہے"), (6, ""), (7, None)]


SAID = [
    (0, "jeː lɛːpʈɑːp hɛː.", "pakistani", ""), (1, "kjɑː ɑːp neː kɑːm kɪjɑː?", "pakistani", ""), (2, "ðˈɪs ɪz ɡˈʊd.", "native", ""), (3, "jeː juː ɛs biː hɛː!", "pakistani", ""),
    (4, "jeː nɑːɖrə, kɪtɑːb hɛː", "pakistani", ""), (5, None, "pakistani", "gadget"), (6, "", "pakistani", ""), (7, "", "pakistani", ""),
]


def _tables(spark):
    return spark.createDataFrame(ENTRIES, "seq int, word string, pron string"), spark.createDataFrame(ENGLISH, "word string, pron string")


@query(values(SAID, "id, phonemes, accent, missing"))
def sentence_phones_golden(spark, sf_dir):
    entries, english = _tables(spark)
    out = frontend.phonemize(spark.createDataFrame(SENTENCES, "id int, text string"), "id", "text", entries, english)
    return out.select("id", "phonemes", "accent", F.array_join("missing", ",").alias("missing"))


@query(values([(0, "kɪtɑːb əʧʧʰiː hɛː", "lexicon,lexicon,lexicon"), (1, "kɪtɑːbeː", "lexicon"), (2, "", "")], "id, phonemes, sources"))
def urdu_span_phones(spark, sf_dir):
    entries, _ = _tables(spark)
    out = frontend.urdu_phones(spark.createDataFrame([(0, "کتاب اچھی  ہے"), (1, "كتابِ"), (2, " ")], "id int, text string"), "id", "text", entries)
    return out.select("id", "phonemes", F.array_join("sources", ",").alias("sources"))


@query(values([(0, 0, "یہ کتاب ہے۔ ہے۔", "jeː kɪtɑːb hɛː. hɛː."), (0, 1, "آپ نے کام کِیا؟", "ɑːp neː kɑːm kɪjɑː?"), (1, 0, "یہ کتاب، یہ کتاب", "jeː kɪtɑːb,"), (1, 1, "یہ کتاب، یہ کتاب", "jeː kɪtɑːb")], "id, n, text, phonemes"))
def chunk_text_golden(spark, sf_dir):
    entries, english = _tables(spark)
    rows = spark.createDataFrame([(0, "یہ کتاب ہے۔ ہے۔ آپ نے کام کِیا؟"), (1, "یہ کتاب، یہ کتاب")], "id int, text string")
    return frontend.chunk_text(rows, "id", "text", least=6, most=20, entries=entries, english=english)


@query(values([("b", "p2", "gold", "x;y;p3"), ("a", "p5", "rules", "p6"), ("c", "p9", "llm", "")], "word, pron, source, variants"))
def lexicon_merge_golden(spark, sf_dir):
    """Variants of a loaded entry stay before later ones; an override replaces what came before it, whatever its rank."""
    rows = [(1, "b", "p1", "llm", ["z"], False), (2, "b", "p2", "gold", ["x", "y"], False), (3, "b", "p3", "llm", [], False), (4, "a", "p4", "gold", ["q"], False), (5, "a", "p5", "rules", [], True), (6, "a", "p6", "neural", [], False), (7, "b", "x", "rules", [], False), (8, "c", "p9", "llm", None, False)]
    df = spark.createDataFrame(rows, "seq int, word string, pron string, source string, variants array<string>, override boolean")
    return lexicon.merge(df).select("word", "pron", "source", F.array_join("variants", ";").alias("variants"))


@query(values([("کتاب", "kɪtɑːb"), ("گھر", "ɡʰər"), ("گھر", "ɡər")], "word, pron"))
def training_pairs_golden(spark, sf_dir):
    entries = spark.createDataFrame([("کتاب", "kɪtɑːb", []), ("گھر", "ɡʰər", ["ɡər", "ɡɪr"]), ("ہے", "hɛː", []), ("ایک دو", "eːk doː", None)], "word string, pron string, variants array<string>")
    return frontend.training_pairs(entries, spark.createDataFrame([("ہے",)], "word string"))


@query(values([(5, "کتاب", "kɪtɑb"), (2, "گھر", "ɡʰər")], "seq, word, pron"))
def usable_candidates_golden(spark, sf_dir):
    lines = [(1, "كتاب\tkɪtɑːb"), (2, "`گھر` ɡʱəɾ"), (3, "قلم\tqələm"), (4, "گھر\t1!x"), (5, "کتاب<TAB>kɪtɑb"), (6, "one")]
    return frontend.usable_candidates(spark.createDataFrame(lines, "seq int, line string"), spark.createDataFrame([("کتاب",), ("گھر",)], "word string"))


@query(values([("a", "x", True), ("b", "T4 x2", False), ("c", "L4", True), ("d", "x", False)], "variant, device, runs"))
def variants_by_device(spark, sf_dir):
    rows = spark.createDataFrame([("a", "NvidiaTeslaT4", "x"), ("b", "NvidiaL4", "T4 x2"), ("c", "NvidiaL4", "L4"), ("d", None, "x")], "variant string, accelerator string, device string")
    return rows.select("variant", "device", admission.runs_on(F.col("accelerator"), F.col("device")).alias("runs"))


@query(values([("Kernel is RUNNING", "running"), ("queued, then error", "queued"), ("has status cancelAcknowledged", "cancel"), ("complete after an error", "complete"), ("", "unknown"), ("?", "unknown")], "said, state"))
def status_class(spark, sf_dir):
    rows = spark.createDataFrame([(s,) for s in ("Kernel is RUNNING", "queued, then error", "has status cancelAcknowledged", "complete after an error", "", "?")], "said string")
    return rows.select("said", admission.state_of(F.col("said")).alias("state"))


BASE = [("کتاب", "kɪtɑːb", "wikipron", []), ("گھر", "ɡər", "llm", [])]


EXTRA = [("گھر", "ɡʰər", "gold", ["ɡʰɪr"]), ("کتاب", "kətɑːb", "rules", []), ("قلم", "qələm", "rules", [])]


LOADED = [("کتاب", "kɪtɑːb", "wikipron", "kətɑːb"), ("گھر", "ɡʰər", "gold", "ɡʰɪr"), ("قلم", "qələm", "rules", "")]


NBEST = [("گھر", [("ɡʰər", -0.1)]), ("قلم", [("xx", -0.1)]), ("دوست", [])]


ANSWERED = [("lexicon", 2), ("neural", 1), ("neural_rejected", 1), ("rules", 2)]


@query(values(LOADED, "word, pron, source, variants"))
def lexicon_load(spark, sf_dir):
    """A base file, then an extra one whose better source takes an entry over."""
    at, kind = folder(spark), "word string, pron string, source string, variants array<string>"
    for name, rows in (("base", BASE), ("extra", EXTRA)):
        files.write_lexicon(spark.createDataFrame(rows, kind), f"{at}/{name}")
    return files.load_lexicon(spark, f"{at}/base", [f"{at}/extra"]).select("word", "pron", "source", F.array_join("variants", ";").alias("variants"))


@query(values(ANSWERED, "source, n"))
def cascade_sources(spark, sf_dir):
    """Two words of the lexicon, three others: one takes a candidate, one refuses it, one has none."""
    entries = spark.createDataFrame(ENTRIES, "seq int, word string, pron string")
    words = spark.createDataFrame([(w,) for w in ("کتاب", "ہے", "گھر", "قلم", "دوست")], "word string")
    nbest = spark.createDataFrame(NBEST, "word string, cands array<struct<pron:string,logp:double>>")
    return frontend.source_counts(frontend.urdu_words(words, entries, nbest=nbest))


@query(values([("کتاب", "ک ت ا ب <sep> k ɪ t ɑː b"), ("گھر", "گ ھ ر <sep> ɡʰ ə r")], "word, tokens"))
def model_source_tokens(spark, sf_dir):
    rows = spark.createDataFrame([("کتاب", "kɪtɑːb"), ("گھر", "ɡʰər")], "word string, said string")
    return rows.select("word", F.array_join(frontend.source_tokens(F.col("word"), F.col("said")), " ").alias("tokens"))


@query(values([("کتاب", "letters want: [k t ʔ? b]  pron has: [k t b]  ok=True"), ("گھر", "letters want: [ɡʰ r]  pron has: [k r]  ok=False"), ("دنیا", "letters want: [d m/n/ŋ j? ʔ? n?]  pron has: [d n j]  ok=True")], "word, report"))
def skeleton_reports(spark, sf_dir):
    rows = spark.createDataFrame([("کتاب", "kɪtɑːb"), ("گھر", "kər"), ("دنیا", "dʊnjɑː")], "word string, pron string")
    return rows.select("word", phones.skeleton_report(F.col("word"), F.col("pron")).alias("report"))


@query(values([("۔کتاب، ", "کتاب"), ("abc گھر 12", "گھر"), ("", "")], "word, letters"))
def letters_of_words(spark, sf_dir):
    rows = spark.createDataFrame([("۔کتاب، ",), ("abc گھر 12",), ("",)], "word string")
    return rows.select("word", letters_only(F.col("word")).alias("letters"))

@pytest.mark.parametrize("name", sorted(QUERIES))
def test_case(spark, sf, name):
    assert rows_of(QUERIES[name](spark, sf)) == rows_of_sql(duckdb.connect(), ORACLES[name])
