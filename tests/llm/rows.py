"""A small table with every case the operators define."""

import random

WORDS = "the of and to in a is that for on as with he it by river stone house green walks often under seven lamps".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", r.choice("abcdefgh") * r.randint(1, 3)]) for _ in range(n))


def documents(spark):
    long_text = prose(1, 9000)
    passage = prose(2, 30)
    base = prose(3, 120)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    rows = [
        (1, base, "en", "a", 10), (2, base, "en", None, None), (3, near, None, "a", 5),
        (4, None, "en", "a", 0), (5, "", "en", "a", 0), (6, " \n\t ", "en", "b", 4),
        (7, long_text, "en", "a", 1), (8, prose(4, 80) + " " + passage + " " + prose(5, 80), "en", "a", 1),
        (9, passage + "\n" + prose(6, 90), "de", "a", 1), (None, prose(7, 70), "en", "a", 1), (None, prose(7, 70), "en", "a", 1),
        (10, "x" * 30000, "en", "a", 1), (11, "héllo wörld ▁ 日本 \x00 " * 12, "fr", "a", 1), (11, "héllo wörld ▁ 日本 \x00 " * 12, "fr", "a", 1),
        (11, prose(8, 60), "en", "a", 1), (12, "mail joe.doe@mail.example.com now, 10.0.0.255 or 4111 1111 1111 1111, +46 (70) 123-45-67.", "en", "c", 2),
        (13, "Released under the MIT License.\nSPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0", "en", "c", 2),
        (14, "One line.\nOne line.\nOne line.\n" * 20, "en", "c", 2), (15, "### *** $$$ &&& " * 30, "en", "c", 2),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


#: names that operators use for columns of their own
CLASHES = (
    "n_tokens ids spans decoded n_words kept shard slot key id row lo bands node comp class_id band piece start length offset "
    "sequence_id text_key told_key terms near labels findings predicted whole size _t _words _rank _salt row_of_class "
    "n_repeat_words n_lines stop_word_ratio _lines _h _n _solid _w _s _at _record crc range _shard _part n_features weight score rank"
).split()


def clashing(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("mine").alias(c) for c in CLASHES])
