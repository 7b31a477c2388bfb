"""Edge cases of detail and account pages."""

from gleanframe.operators import details as d


def pages(spark, *html):
    return spark.createDataFrame([(str(n), h) for n, h in enumerate(html)], "url string, html string")


def tile(key, value=""):
    return (f'<div class="b-advert-attribute"><div class="b-advert-attribute__key">{key}</div>'
            f'<div class="b-advert-attribute__value">{value}</div></div>')


def tiles(*cells):
    return ('<div class="b-advert-attributes-wrapper"><div class="b-advert-attributes--tiles">'
            + "".join(cells) + "</div></div>")


def eight(spark, html):
    return d.detail_fields_8(pages(spark, html), "on Market").first()


def sixteen(spark, html):
    return d.detail_record_16(pages(spark, html)).first()


def test_empty_page(spark):
    assert set(eight(spark, "").asDict().values()) == {None, "0"}
    assert {k: v for k, v in sixteen(spark, "").asDict().items() if v is not None} == {"property_url": "0"}


def test_blank_description_wins_because_it_is_not_stripped(spark):
    assert eight(spark, '<div class="x-description"> </div><div class="description">y</div>').description == " "


def test_empty_matching_tiles(spark):
    page = tiles(tile("Estate name"), tile("Built"), tile("Condition", "New"), tile("Toilets"))
    row = eight(spark, page)
    assert (row.estate_name, row.condition, row.toilets) == ("", "", None)
    assert eight(spark, tiles(tile("Toilets"), tile("Bathrooms"))).toilets == ""
    assert eight(spark, tiles(tile("Toilets"), tile("Bathrooms", " 2 baths"))).toilets == "2"


def test_keyword_choice_follows_tile_order(spark):
    page = tiles(tile("Status", "Sold"), tile("Condition", "New"))
    assert eight(spark, page).condition == "Sold"


def test_exact_key_ignores_case_and_blanks(spark):
    assert eight(spark, tiles(tile(" ESTATE Name\n", " X "))).estate_name == "X"
    assert eight(spark, tiles(tile("Estate name 2", "X"))).estate_name is None


def test_detail_lines(spark):
    def lines(*spans):
        inner = "".join(f'<span class="qa-description-text">{s}</span>' for s in spans)
        return eight(spark, f'<div class="b-advert__description-wrapper">{inner}</div>').property_details

    assert lines(" a ", "  ", "b<br>c") == "a\nb\nc"
    assert lines("  ") == ""
    assert lines() is None


def test_time_on_site_falls_back_to_part_of_class(spark):
    stat = '<div class="b-seller-block__info__stat">{}</div>'
    page = stat.format("Replies fast") + stat.format(" 2 years on Market ")
    assert eight(spark, page).time_on_site == "2 years on Market"
    assert eight(spark, '<div class="x-seller-block__info__stat">1 year on Market</div>').time_on_site == "1 year on Market"
    # the phrase has to be in the first text node there
    other = '<div class="x-seller-block__info__stat">1 year<b></b> on Market</div>'
    assert eight(spark, other).time_on_site is None


def test_last_tile_of_a_class_wins_even_empty(spark):
    page = tiles(tile("Furnishing", "a"), tile("Furnishing"), tile("Condition", "x"),
                 tile("Property size condition", "9"), tile("Second condition", "y"))
    row = sixteen(spark, page)
    assert (row.furnishing, row.condition, row.property_size) == (None, "y", "9")


def test_icons(spark):
    def icons(*names):
        return ('<div class="b-advert-icon-attributes-container">' + "".join(
            f'<div class="b-advert-icon-attribute"><span> {n} </span></div>' for n in names) + "</div>")

    row = sixteen(spark, icons("1 Bedroom", "2 bdrm bathroom", "3 bathrooms", "", "4 toilets"))
    assert (row.type, row.bedrooms, row.bathrooms, row.toilets) == (
        "1 Bedroom", "2 bdrm bathroom", "3 bathrooms", "4 toilets")
    assert sixteen(spark, icons("4 toilets") + tiles(tile("Toilets"))).toilets is None
    assert sixteen(spark, icons("4 toilets") + tiles(tile("Toilets", "5"))).toilets == "5"


def test_location(spark):
    def at(text):
        row = sixteen(spark, f'<div class="b-advert-info-statistics--region">{text}</div>')
        return row.location, row.property_address, row.estate_name

    assert at(" A / B , C, now ") == ("A / B , C", "A / B , C", "B , C")
    assert at("A/, now") == ("A/", "A/", None)
    assert at(" , now") == ("", None, None)
    assert at("Plain") == ("Plain", "Plain", None)


def test_price_with_period(spark):
    def price(inner):
        row = sixteen(spark, f'<div class="qa-advert-price-view">{inner}</div>')
        return row.price_rent, row.price_with_period

    value = '<span class="qa-advert-price-view-value"> 5 </span>'
    period = '<span class="b-alt-advert-price__period"> a month</span>'
    assert price(value + period) == ("5", "5 a month")
    assert price(period + value) == ("5", "a month 5")
    assert price("") == (None, None)
    assert price('<span class="qa-advert-price-view-value"> </span>') == ("", None)


def test_account_records_and_rejects(spark):
    def account(heading="Account: a:b", price="KES 9 S x", items=("l", "c", "r"), seller="s"):
        cells = "".join(f"<li><p>{x}</p></li>" for x in (price, *items))
        return (f'<div class="slider-left"><h1> {heading} </h1></div><aside class="panel-details"><ul>{cells}'
                f'</ul></aside><span class="name"><a> {seller} </a></span>')

    df = pages(spark, account(), account(heading="none"), account(price="9"), account(items=("l",)),
               "", account(seller="&nbsp;"))
    good = {r.url: r for r in d.account_record_7(df).collect()}
    assert set(good) == {"0", "5"}
    assert (good["0"].description, good["0"].price, good["0"].seller) == (" a:b", " 9 ", "s")
    assert good["5"].seller == ""
    assert {r.url: r.failed_field for r in d.account_rejects(df).collect()} == {
        "1": "description", "2": "price", "3": "category", "4": "description"}
