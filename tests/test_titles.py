"""N*/A*: golden titles, one per rule branch."""
import pytest
from pyspark.sql import functions as F

from sameitem.functions.titles import with_attributes

CASES = [
    ("Samsung Galaxy S23 128GB Black", "samsung galaxy s23 128gb black",
     dict(brand="samsung", model_family="galaxy", model_number="s23", storage="128gb", color="black", category="phone")),
    ("סמסונג גלקסי S23 שחור 128 גיגה", "samsung galaxy s23 black 128gb",
     dict(brand="samsung", model_family="galaxy", model_number="s23", storage="128gb", color="black")),
    ("Apple iPhone  15 Pro 1TB Natural Titanium", "apple iphone 15 pro 1024gb natural titanium",
     dict(brand="apple", model_family="iphone", model_number="15", tier_variant="pro", storage="1024gb", color="natural")),
    ("AirPods Pro 2nd gen", "airpods pro gen2",
     dict(brand="apple", model_family="airpods", model_number="gen2", tier_variant="pro", category="earbuds")),
    ("Nintendo Switch OLED", "nintendo switch oled",
     dict(brand="nintendo", model_family="switch", display_variant="oled", category="console")),
    ("Apple Watch Series 9 45mm GPS + Cellular", "apple watch series 9 45mm gps cellular",
     dict(model_family="watch", model_number="9", screen_size="45", connectivity="gps_cellular")),
    ("Sony WH-1000-XM5 מחודש", "sony wh1000xm5 refurbished",
     dict(brand="sony", model_family="wh1000x", model_number="xm5", condition="refurbished", category="headphones")),
    ("Lenovo IdeaPad 5 16 RAM 512 SSD 15.3 inch", "lenovo ideapad 5 16gb ram 512ssd 15.3 inch",
     dict(model_family="ideapad", model_number="5", ram="16gb", storage="512gb", screen_size="15")),
    ("iphone 15 512gb", "iphone 15 512gb", dict(screen_size="15", storage="512gb", brand="apple")),
    ("xiaomi redmi note 13 pro+ 8gb 256gb", "xiaomi redmi note 13 pro 8gb 256gb",
     dict(model_family="redmi_note", model_number="13", ram="8gb", storage="256gb")),
    ("galaxy s23", "galaxy s23", dict(brand=None, model_family="galaxy", model_number="s23")),
]


@pytest.mark.parametrize("title,norm,attrs", CASES)
def test_golden_titles(spark, title, norm, attrs):
    df = spark.createDataFrame([(1, title)], "listing_id long, title string")
    r = with_attributes(df).collect()[0].asDict()
    assert r["normalized_title"] == norm
    for k, v in attrs.items():
        assert r[k] == v, (k, r[k], v)
    assert r["brand_confidence"] == ("high" if r["brand"] else "missing")
