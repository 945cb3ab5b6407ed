from carrel.operators import prompts


def test_blocks(spark):
    items = spark.createDataFrame([(220, "Sex", "sex", 1, "", ""), (390, "Date", "", 8, "date", ""), (400, "Site", "primarySite", 4, "", ""), (820, "Nodes", "nodes", 2, "digits", "00-99"), (522, "Histology", "hist", 4, "", ""), (2600, "Text", "text", 5, "", "")], "item int, name string, xml_id string, length int, data_type string, allowable_values string")
    codes = spark.createDataFrame([(220, "1=Male; 2=Female")], "item int, codes_text string")
    lines = prompts.field_instructions(items, codes).first()["instructions"].split("\n")
    assert lines[0] == '"sex": Sex (item 220). Valid codes: 1=Male; 2=Female'
    assert lines[1].startswith('"item_390": Date') and "YYYYMMDD" in lines[1] and "topography" in lines[2] and "morphology" in lines[3]
    assert lines[4].endswith("2-digit number. 00-99") and lines[5].endswith("at most 5 characters")

    results = spark.createDataFrame([("a", 400, "Site", "C50", "", 0.5), ("a", 220, "Sex", "F", "2", 0.9), ("a", 390, "Date", "x", "", 0.0), ("a", 2600, "Text", "long text", "long", 0.7)], "k string, item int, name string, extracted string, resolved string, confidence double")
    units = spark.createDataFrame([("a",), ("b",)], "k string")
    prior = {r["k"]: r["prior"] for r in prompts.prior_state(results, units, ["k"]).collect()}
    assert prior["a"].split("\n")[1:3] == ["- Sex (item 220): 2 (confidence 0.90)", "- Site (item 400): C50 (confidence 0.50)"] and prior["b"] == prompts.NO_STATE
    told = {r["k"]: r["narratives"] for r in prompts.prior_narratives(results, units, ["k"], [2600]).collect()}
    assert told["a"].endswith("- Text: long") and told["b"] == prompts.NO_NARRATIVES

    payload = spark.createDataFrame([("a", "text", "123456789", 0.4), ("a", "other", "x", 1.0)], "k string, field string, value string, model_confidence double")
    assert [tuple(r) for r in prompts.narrative_results(payload, items).collect()] == [("a", 2600, "123456789", "12345", 0.4)]
    labels = spark.createDataFrame([("C61", "Prostate"), ("C50", "Breast")], "code string, label string")
    assert prompts.code_table(labels, "Sites").first()["table_text"] == "Sites:\nC50 Breast\nC61 Prostate"
