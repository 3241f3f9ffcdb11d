from paddock.sources import sections

PAGE = """<html><head><style>p{}</style></head><body><nav><ul><li>Home</li></ul></nav><p>outside</p>
<section id="other"><div class="col-xs-12 col-md-8"><div class="content"><p>wrong section</p></div></div></section>
<section id="overview_anchor"><div class="col-xs-12"><div class="content"><p>wrong column</p></div></div>
 <div class="col-xs-12 col-md-8"><p>before content</p><div class="content x"><p> One <b>bold</b> end </p><p class="a small">small</p>
 <!-- <p>hidden</p> --><div><p>Two &amp; three</p></div><p>Open<p>Next<ul><li>no paragraph</li></ul></div>
 <div class="content"><p>second content</p></div></div></section>
<section class="maincontent wide"><div class="row"><div class="col-xs-12 col-md-8"><div class="content"><p>main column</p></div></div>
 <div class="col-xs-12 col-md-4"><div class="content"></div></div></div>
 <div class="row"><div class="col-xs-12"><div class="content"><p>First</p><ul><li>a</li><li>b <ul><li>c</li></ul></li></ul><p class="small">no</p>
 <div><p>deeper</p></div><p>Last</p></div></div><div class="col-xs-12"><div class="content"><p>too late</p></div></div></div></section>
<table><tr><td class="label">Other:</td><td class="content">table</td></tr></table>
<table class="x fahrzeugdaten"><tr><td class="label">Mileage::</td><td class="content">5 km</td></tr><tr><td class="label">alone</td></tr>
 <tr><td class="label">Year:</td><td class="content"><span>19</span><span>90</span></td></tr><tr><td class="label">Mileage:</td><td class="content">6 km</td></tr></table>
<div class="price"><span class="p">EUR 1</span></div><div class="sidebar-section"><div class="price"><b>x</b><span class="p">&nbsp;EUR 5 </span></div></div>
<h1 data-x="a > b"> Carrera <b>RS</b></h1><script>var t = "</p>";</script></body></html>"""


def read(spark, html, **more):
    columns = {"html": html, **more}
    frame = spark.createDataFrame([tuple(columns.values())], ", ".join(f"`{c}` string" for c in columns))
    return sections.extract_sections(frame).first().asDict()


def test_fields_come_from_their_sections_in_page_order(spark):
    row = read(spark, PAGE)
    assert row["Description"] == "Oneboldend\nTwo & three\nOpen\nNext"
    assert row["Secondary_Description"] == "First\na\nbc\nc\nLast"
    assert row["specs"] == {"Mileage": "6 km", "Year": "1990"}
    assert row["Price"] == "EUR 5" and row["Title"] == "CarreraRS"


def test_pages_without_sections_and_odd_markup(spark):
    for html in ("", "plain", "<", "a < b", "</p></div>", "<p>only", "<!-- open", "<script>x", "<section id='overview_anchor'>"):
        row = read(spark, html)
        assert row["Description"] is None and row["Secondary_Description"] is None and row["Price"] is None and not row["specs"], html
    assert read(spark, None)["specs"] is None
    assert read(spark, "<h1>a < b</h1>")["Title"] == "a<b"


def test_elements_left_open_and_clashing_names(spark):
    html = "<section id=overview_anchor><div class='col-xs-12 col-md-8'><div class='content'><p>kept"
    row = read(spark, html, elements="e", texts="t", events="v", Price="own")
    assert row["Description"] == "kept" and (row["elements"], row["texts"], row["events"]) == ("e", "t", "v") and row["Price"] is None


def test_every_element_has_its_ancestors_and_texts(spark):
    html = "<div>a<p>b<span>c</span><p>d</div><ul><li>e<li>f</ul>"
    frame = sections.page_elements(spark.createDataFrame([(html,)], "html string"), "html", "found", "nodes").first()
    own = {e["n"]: e for e in frame["found"]}
    shown = [(e["tag"], "".join(frame["nodes"][e["start"]:e["stop"]]), [own[n]["tag"] for n in e["path"][1:]]) for e in frame["found"]]
    assert shown == [
        ("page", "abcdef", []), ("div", "abcd", ["page"]), ("p", "bc", ["div", "page"]), ("span", "c", ["p", "div", "page"]),
        ("p", "d", ["div", "page"]), ("ul", "ef", ["page"]), ("li", "e", ["ul", "page"]), ("li", "f", ["ul", "page"]),
    ]
