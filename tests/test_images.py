"""One address may stand for several images."""

from loomwork.operators import gates


def test_images_of_one_address_keep_their_own_hashes(spark):
    images = spark.createDataFrame([(1, "https://a/x"), (2, "https://a/x"), (3, "https://a/x"), (4, "http://b/y")], "id int, url string")
    hashes = spark.createDataFrame([(1, "0" * 64), (2, "abc")], "id int, sha256 string")
    got = gates.image_problems(images, "url", hashes, "https://", "id")
    assert sorted(map(tuple, got.collect())) == [("http://b/y", "unexpected host"), ("https://a/x", "malformed hash"), ("https://a/x", "no recorded hash")]
