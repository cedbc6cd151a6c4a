"""Context features of hand-made tagged sentences, and the scans against plain loops on random ones."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from termloom.functions import features, tagging


def rendered(spark, line: str, cs: int, ce: int, language: str = "en", **context) -> dict:
    row = {"line": line, "cs": cs, "ce": ce, "sent_id": 3, "section": "TITLE", "sent_in_section": 0} | context
    frame = spark.createDataFrame([tuple(row.values())], "line string, cs int, ce int, sent_id int, section string, sent_in_section int")
    ctx = {c: F.col(c) for c in ("sent_id", "section", "sent_in_section")}
    made = features.render(language, tagging.parse_tagged(F.col("line")), F.col("cs"), F.col("ce"), ctx)
    return dict(x.split("=", 1) for x in frame.select(made.alias("f")).first()["f"])


def test_common_features(spark):
    f = rendered(spark, "the_DT Optical_JJ Communications_NNS of_IN light_NN ._.", 1, 3)
    assert f["doc_loc"] == "3" and f["sent_loc"] == "1-3" and f["section_loc"] == "TITLE_sent1"
    assert f["prev_n3"] == "^_^_the" and f["prev_n2"] == "^_the" and f["next_n3"] == "of_light_." and f["next_n2"] == "of_light"
    assert f["next2_tags"] == "IN_NN" and f["last_word"] == "communications" and f["suffix3"] == "ons" and f["suffix5"] == "tions"
    assert f["first_word"] == "optical" and f["plen"] == "2" and f["tag_sig"] == "JJ_NNS"
    assert rendered(spark, "a_NN", 0, 1, sent_in_section=1)["section_loc"] == "TITLE_later"
    assert "next2_tags" not in rendered(spark, "a_NN", 0, 1) and "suffix3" not in rendered(spark, "abcde_NN", 0, 1)


def test_english_scans(spark):
    assert rendered(spark, "we_PRP looked_VBD up_RP at_IN the_DT sky_NN", 5, 6)["prev_V"] == "looked_up_at"
    assert "prev_V" not in rendered(spark, "Using_VBG sky_NN", 1, 2)  # token 0 is never seen
    assert "prev_V" not in rendered(spark, "x_DT the_DT coated_VBN glass_NN", 3, 4)  # a participle after a determiner
    assert rendered(spark, "x_DT is_VBZ coated_VBN glass_NN", 3, 4)["prev_V"] == "coated"
    assert rendered(spark, "x_DT see_VB method_NN of_IN the_DT glass_NN", 5, 6)["prev_Npr"] == "method_of"
    assert rendered(spark, "x_DT see_VB method_NN of_IN the_DT glass_NN", 5, 6)["prev_VNP"] == "see|method|of"
    assert rendered(spark, "x_DT is_VBZ equal_JJ to_TO glass_NN", 4, 5)["prev_Jpr"] == "equal_to"
    assert rendered(spark, "x_DT red_JJ glass_NN", 2, 3)["prev_J"] == "red"


def test_other_languages(spark):
    de = rendered(spark, "x_ART Haus_NN sieht_VVFIN rote_ADJA Dach_NN von_APPR Ulm_NE", 3, 7, "de")
    assert de["prev_V"] == "sieht" and de["prev_N"] == "haus" and de["initial_J"] == de["chunk_lead_J"] == "rote" and de["von_head"] == "dach"
    assert "prev_J" not in rendered(spark, "Dach_NN rot_ADJA", 0, 1, "de")  # nothing before the first token
    cn = rendered(spark, "x_DT 三_CD 个_M 大_JJ 系统_NN", 3, 5, "cn")
    assert cn["prev_CD_M"] == "三_个" and cn["first_Adj"] == "大" and cn["prev_J"] == "大" and "prev_DT" not in cn
    assert rendered(spark, "y_NN 该_DT 个_M 系统_NN", 3, 4, "cn")["prev_DT"] == "该"


AUX = {"be", "is", "are", "was", "were", "been", "being", "am", "has", "have", "had", "having"}


def plain_verb(toks, at):
    """The governing verb left of ``at`` with up to two prepositions, by the rules in order."""
    prep = prep2 = ""
    for i in range(at - 1, 0, -1):
        (w, t), (bw, bt) = toks[i], toks[i - 1]
        if t in ("VBG", "VBP", "VBZ", "VB"):
            return "_".join(filter(None, (w, prep, prep2)))
        if t in ("VBD", "VBN"):
            if not (bt == "DT" or (bt.startswith("V") and bw not in AUX)):
                return "_".join(filter(None, (w, prep, prep2)))
        elif t.startswith("N") or (t.startswith("J") and prep):
            return None
        elif t in ("RP", "IN", "TO"):
            prep, prep2 = w, prep
        elif w == "," and prep:
            return None
    return None


def plain_pair(toks, at, stop, skip_after):
    """A preposition and, beyond it, the wanted word, within four tokens."""
    prep = ""
    for i in range(at - 1, max(0, at - 5), -1):
        w, t = toks[i]
        if t in ("RP", "IN", "TO"):
            prep = w
        elif t.startswith(stop) and prep:
            return i, w, prep
        elif t[0] in "JD" and (skip_after or not prep):
            continue
        else:
            return None
    return None


def test_scans_on_random_sentences(spark):
    r = random.Random(12)
    tags = "NN NNS JJ DT VB VBD VBN VBG VBZ IN TO RP CC ,".split()
    rows = []
    for k in range(2500):
        toks = [(("," if t == "," else r.choice(["is", "had", "made", "w1", "w2"])), t) for t in r.choices(tags, k=r.randint(1, 10))]
        rows.append((k, [(w, w, t) for w, t in toks], r.randrange(len(toks))))
    frame = spark.createDataFrame(rows, "k int, toks array<struct<tok: string, lc: string, tag: string>>, cs int")
    made = features.render("en", F.col("toks"), F.col("cs"), F.col("cs") + 1, {}, ["prev_V", "prev_Npr", "prev_VNP", "prev_Jpr", "prev_J"])
    for x in frame.select("k", made.alias("f")).collect():
        toks, cs = [(w, t) for w, _, t in rows[x["k"]][1]], rows[x["k"]][2]
        want = {"prev_V": plain_verb(toks, cs)}
        noun, adj = plain_pair(toks, cs, "N", False), plain_pair(toks, cs, "J", True)
        want["prev_Npr"] = noun and f"{noun[1]}_{noun[2]}"
        verb = noun and plain_verb(toks, noun[0])
        want["prev_VNP"] = verb and f"{verb}|{noun[1]}|{noun[2]}"
        want["prev_Jpr"] = adj and f"{adj[1]}_{adj[2]}"
        want["prev_J"] = toks[cs - 1][0] if cs and toks[cs - 1][1].startswith("J") else None
        assert dict(v.split("=", 1) for v in x["f"]) == {k: v for k, v in want.items() if v}, (toks, cs)
