import json

from relnorm.plans import adjacent

RUN_TS = "2024-01-01 00:00:00.000000+00:00"


def _write(root):
    with open(f"{root}/mitchells.csv", "w") as fh:
        fh.write(",ID,CHAIN_ID,TITLE,POLITICS,PERSONS,ORGANIZATIONS,PRICE,YEAR,PLACE_PUB,PLACE_PUB_WIKI,"
                 "PLACE_PUB_COORD,PLACES,PLACES_TRES,ESTABLISHED_DATE,PUBLISED_DATE,TEXT\n")
        fh.write('0,101,1,Liverpool Mercury,liberal<SEP> independent,A. Smith,Org,1d<SEP>2d ,1846,Liverpool,Q24826,'
                 '"(1,2)",x,y,1811,Friday,"text, with comma"\n')
        fh.write("1,102,2,Bath Chronicle,conservative,,,1d,1847,Bath,Q22889,x,x,y,1760,Thursday,t\n")
        fh.write("2,103,3,Unlinked,,,,,1846,Nowhere,Q999,x,x,y,,,t\n")
        fh.write("3,104,4,Lost place,liberal,,,3d,1850,Far,Q12345,x,x,y,,,t\n")
    with open(f"{root}/gazetteer.csv", "w") as fh:
        fh.write("wikidata_id,english_label,latitude,longitude,geonamesIDs,extra\n")
        fh.write("Q24826,Liverpool,53.4,-2.98,2644210,a\n")
        fh.write("Q22889,Bath,51.38,-2.36,2656173,b\n")
        fh.write("Q1,Unmentioned,0,0,1,c\n")
    json.dump({"Q24826": ["Q23100", "Merseyside"], "Q22889": ["Somerset", "Q23157"]},
              open(f"{root}/admin.json", "w"))
    json.dump({"Q24826": ["Lancashire", "Q23077"], "Q22889": ["Q23157", "Somerset"]},
              open(f"{root}/historic.json", "w"))
    json.dump({"Q24826": ["Q21", "England"], "Q22889": ["England", "Q21"]},
              open(f"{root}/countries.json", "w"))
    with open(f"{root}/linking.csv", "w") as fh:
        cols = adjacent.LINKING_COLUMNS
        fh.write(",".join(cols) + "\n")
        fh.write("0003548," + ",".join(["x"] * (len(cols) - 2)) + ",101\n")
        fh.write("0002083," + ",".join(["x"] * (len(cols) - 2)) + ",102\n")
        fh.write("7777777," + ",".join(["x"] * (len(cols) - 2)) + ",104\n")
    json.dump([{"pk": 1187, "model": "newspapers.newspaper", "fields": {"publication_code": "0003548"}},
               {"pk": 5, "model": "newspapers.newspaper", "fields": {"publication_code": "0002083"}},
               {"pk": 9, "model": "newspapers.newspaper", "fields": {"publication_code": "0002083"}}],
              open(f"{root}/Newspaper-1.json", "w"))


def test_adjacent_tables(spark, scratch):
    _write(scratch)
    inputs = adjacent.read_inputs(spark, f"{scratch}/mitchells.csv", f"{scratch}/gazetteer.csv",
                                  f"{scratch}/historic.json", f"{scratch}/admin.json",
                                  f"{scratch}/countries.json", f"{scratch}/linking.csv",
                                  f"{scratch}/Newspaper-1.json")
    t = adjacent.build_tables(spark, run_ts=RUN_TS, **inputs)

    places = {r.wikidata_id: r for r in t["gazetteer.Place"].collect()}
    assert set(places) == {"Q22889", "Q24826"}          # only mentioned places
    assert places["Q22889"].pk == 1 and places["Q24826"].pk == 2
    assert all(p.admin_county is not None for p in places.values())   # no place without admin county
    admin = {r.wikidata_id: r for r in t["gazetteer.AdminCounty"].collect()}
    assert admin["Q23157"].label == "Somerset" and admin["Q23100"].label == "Merseyside"
    assert places["Q22889"].admin_county == admin["Q23157"].pk

    lean = {r.label: r.pk for r in t["mitchells.PoliticalLeaning"].collect()}
    assert lean == {"conservative": 1, "independent": 2, "liberal": 3}
    price = {r.label: r.pk for r in t["mitchells.Price"].collect()}
    assert price == {"1d": 1, "2d": 2, "3d": 3}
    assert [r.year for r in t["mitchells.Issue"].orderBy("pk").collect()] == [1846, 1847, 1850]

    entries = {r.title: r for r in t["mitchells.Entry"].collect()}
    assert set(entries) == {"Liverpool Mercury", "Bath Chronicle", "Lost place"}   # inner link
    lm = entries["Liverpool Mercury"]
    assert lm.pk == 1 and lm.newspaper == 1187                 # entry linked to its newspaper
    assert lm.political_leanings == [lean["liberal"], lean["independent"]]
    assert lm.prices == [price["1d"], price["2d"]]
    assert lm.political_leaning_raw == ["liberal", " independent"]
    assert lm.place_of_publication == places["Q24826"].pk and lm.issue == 1
    assert entries["Bath Chronicle"].newspaper == 5            # first of many
    lost = entries["Lost place"]
    assert lost.place_of_publication is None and lost.newspaper is None
    assert {r.place_of_publication_id for r in t["places_not_found"].collect()} == {"Q12345"}
    assert {r.code for r in t["papers_not_found"].collect()} == {"7777777"}
    assert {r.publication_code for r in t["papers_many"].collect()} == {"0002083"}
    assert {r.created_at for r in t["mitchells.Entry"].collect()} == {RUN_TS}


def test_adjacent_export(spark, scratch):
    _write(scratch)
    inputs = adjacent.read_inputs(spark, f"{scratch}/mitchells.csv", f"{scratch}/gazetteer.csv",
                                  f"{scratch}/historic.json", f"{scratch}/admin.json",
                                  f"{scratch}/countries.json", f"{scratch}/linking.csv",
                                  f"{scratch}/Newspaper-1.json")
    out = f"{scratch}/out"
    counts = adjacent.run(spark, inputs, out, RUN_TS)
    assert counts["mitchells.Entry"] == 3 and counts["papers_not_found"] == 1
    assert {r.check: r.n_rows for r in spark.read.json(f"{out}/checks").collect()} == {
        "unresolved issue": 0, "unresolved place_of_publication": 1}
    for name in [k for k in counts if "." in k]:
        n_json = spark.read.json(f"{out}/{name}.json").count()
        n_csv = spark.read.option("header", "true").option("multiLine", "true").csv(f"{out}/{name}.csv").count()
        assert n_json == n_csv == counts[name]
