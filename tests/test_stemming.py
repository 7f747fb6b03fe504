from __future__ import annotations

from pyspark.sql import functions as F

from precis.functions import stemming
from precis.operators import rouge

# The examples of the paper, each taken through all steps.
STEMS = """
caresses caress  ponies poni  ties tie  caress caress  cats cat  feed feed  agreed agre  plastered plaster
bled bled  motoring motor  sing sing  conflated conflat  troubled troubl  sized size  hopping hop  tanned tan
falling fall  hissing hiss  fizzed fizz  failing fail  filing file  happy happi  sky sky  relational relat
conditional condit  rational ration  valenci valenc  hesitanci hesit  digitizer digit  conformabli conform
radicalli radic  differentli differ  vileli vile  analogousli analog  vietnamization vietnam  predication predic
operator oper  feudalism feudal  decisiveness decis  hopefulness hope  callousness callous  formaliti formal
sensitiviti sensit  sensibiliti sensibl  triplicate triplic  formative form  formalize formal  electriciti electr
electrical electr  hopeful hope  goodness good  revival reviv  allowance allow  inference infer  airliner airlin
gyroscopic gyroscop  adjustable adjust  defensible defens  irritant irrit  replacement replac  adjustment adjust
dependent depend  adoption adopt  homologou homolog  communism commun  activate activ  angulariti angular
homologous homolog  effective effect  bowdlerize bowdler  probate probat  rate rate  cease ceas  controll control
roll roll  dying die  skies sky  died die  dies die  spied spi  enjoy enjoy  by by  generalizations gener
oscillators oscil  geology geolog  hopefully hope  news news
""".split()


def test_stems_of_the_paper(values):
    words, want = STEMS[::2], STEMS[1::2]
    got = values([(w,) for w in words], "word string", stemming.stems(F.array("word"))[0])
    assert dict(zip(words, got, strict=True)) == dict(zip(words, want, strict=True))


def test_y_is_a_vowel_after_a_consonant(values):
    words = ["toy", "syzygy", "cry", "yes", "sayyid"]
    got = values([(w,) for w in words], "word string", F.regexp_replace("word", stemming.VOWEL, "V"))
    assert got == ["tVy", "sVzVgV", "crV", "yVs", "sVyVVd"]


def test_short_tokens_keep_their_endings(values):
    got = values([("He was flying and uses cats",)], "text string", stemming.stemmed_tokens(F.col("text")))
    assert got == [["he", "was", "fli", "and", "use", "cat"]]


def test_rouge_with_stems(spark):
    df = spark.createDataFrame([("police killed the gunmen", "police kill the gunmen")], "p string, r string")
    assert rouge.score_texts(df, "p", "r").first().rouge1 == 0.75
    assert rouge.score_texts(df, "p", "r", stemming.stemmed_tokens).first().rouge1 == 1
