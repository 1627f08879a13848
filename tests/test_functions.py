import pytest

from tagloom.functions import keys, qualifiers, text

MD5 = "f" * 32
UUID = "ABCDEF01-2345-6789-ABCD-EF0123456789"


@pytest.mark.parametrize("key, first, last", [("a:b:c", "a", "a:b"), ("abc", None, None), (":x", "", ""), ("a:", "a", "a")])
def test_key_prefixes(one, key, first, last):
    assert one(keys.key_prefix_first, key) == first
    assert one(keys.key_prefix_last, key) == last


@pytest.mark.parametrize(
    "key, strict, loose",
    [
        (f"{MD5}:didmd5", True, True),
        (f"{UUID.lower()}:ifa", True, True),
        (f"{'a' * 32}:foobar", True, True),  # the kind is not checked
        (f"{UUID}:ifa", False, True),  # upper case
        (f"{MD5}:ifa", False, True),  # total length
        (f"{MD5}didmd5x", False, False),  # no colon
        (f"{MD5[:20]}:didmd5", False, False),
        (f"{MD5}:d:dmd5", True, True),
    ],
)
def test_key_checks(one, key, strict, loose):
    assert one(keys.key_is_wellformed, key) is strict
    assert one(keys.key_is_loose_ok, key) is loose


@pytest.mark.parametrize("os, key", [("0", "abc:didmd5"), ("1", "abc:ifa"), ("2", "abc:ifa"), (None, "abc:ifa")])
def test_key_by_os(one, os, key):
    assert one(keys.build_key_by_os, "ABC", os) == key


def test_ids(one):
    assert one(keys.build_key_by_hyphen, UUID) == f"{UUID.lower()}:ifa"
    assert one(keys.build_key_by_hyphen, MD5) == f"{MD5}:didmd5"
    assert one(keys.os_of_id, UUID) == "1"
    assert one(keys.os_of_id, MD5) == "0"
    assert one(keys.normalize_id, "\t A b\x00\r\n") == "a b"
    assert one(keys.display_did, UUID.lower()) == UUID
    assert one(lambda c: keys.display_did(c, with_kind=True), MD5) == f"{MD5}:didmd5"


def test_paths(one):
    assert one(keys.kind_from_path, "ids/android/x.csv") == "didmd5"
    assert one(keys.kind_from_path, "ids/ios/x.csv") == "ifa"
    assert one(keys.processed_path, "ids/x.part.csv") == "ids/x_proceed.csv"
    assert one(keys.processed_path, "ids/x") == "ids/x"


@pytest.mark.parametrize("q", ["kd_01", "k_d", "KD", "_ap_1", "kd", "mh_01", "a\n", "12a3b_", "é_ü"])
def test_legal_columns(one, q):
    assert one(qualifiers.is_legal_column, q) is True


@pytest.mark.parametrize("q", ["bad_x", "x_ap_1", "k", "", "123", "kd\n", "k_1\n2d"])
def test_illegal_columns(one, q):
    assert one(qualifiers.is_legal_column, q) is False


@pytest.mark.parametrize(
    "q, recoded",
    [
        ("mh_012345", "0100120345"),
        ("mh_012", "0100120"),
        ("mh_01", None),
        ("td_1", "0111"),
        ("up_1", "0121"),
        ("ap_1", "0151"),
        ("kd_1", "0171"),
        ("am_1", "0181"),
        ("qx_1", "0191"),
        ("sz_1", "0211"),
        ("zz_1", "zz_1"),
        ("kd", "kd"),
    ],
)
def test_recode(one, q, recoded):
    assert one(qualifiers.recode_qualifier, q) == recoded


@pytest.mark.parametrize(
    "q, vendor, code",
    [
        ("kd_017_9", "kd", "017"),
        ("kd", "kd", None),
        ("kd_", "kd", None),
        ("kd__", "kd", None),
        ("kd__9", "kd", ""),
        ("_ap_1", "", "ap"),
        ("kd_017_", "kd", "017"),
    ],
)
def test_vendor_and_code(one, q, vendor, code):
    assert one(qualifiers.vendor_of, q) == vendor
    assert one(qualifiers.code_of, q) == code


def test_insert_and_strip(one):
    assert one(qualifiers.insert_at, "abcdefgh") == "abcdef0gh"
    assert one(qualifiers.insert_at, "abcdef") == "abcdef0"
    assert one(qualifiers.insert_at, "abcde") is None
    assert one(lambda c: qualifiers.insert_at(c, 1, "--"), "ab") == "a--b"
    assert one(qualifiers.strip_vendor, "kd_017") == "017"
    assert one(qualifiers.strip_vendor, "kd") == ""


@pytest.mark.parametrize(
    "line, delimiter, n, item",
    [
        ("a|b", "|", 1, "b"),
        ("a.b", ".", 0, "a"),
        ("a,b", ",", 5, None),
        ("a,b,,", ",", 2, None),
        ("a,,b", ",", 1, ""),
        (",,", ",", 0, None),
        ("", ",", 0, ""),
        ("a||b||", "||", 1, "b"),
    ],
)
def test_split_take_nth(one, line, delimiter, n, item):
    assert one(lambda c: text.split_take_nth(c, delimiter, n), line) == item


@pytest.mark.parametrize("tags, items", [("a,b,,", ["a", "b"]), ("", [""]), (",", []), ("a,,b", ["a", "", "b"]), (",a", ["", "a"])])
def test_split_tag_list(one, tags, items):
    assert one(text.split_tag_list, tags) == items


def test_date_range(one):
    assert one(text.date_range, "20240228", "20240301") == ["20240228", "20240229", "20240301"]
    assert one(text.date_range, "20240301", "20240228") == []
    assert one(text.date_range, "20231231", "20231231") == ["20231231"]


def test_times_and_json(one):
    assert one(text.ms_to_datetime, "1502640000999") == "2017-08-13 16:00:00"
    line = '{"did":"0f939ac87c40a5a55716901f099ca61b","tags":["kd_017001003003","kd_017004001004","kd_017004002003"]}'
    parsed = one(text.parse_export_json, line)
    assert parsed.did == "0f939ac87c40a5a55716901f099ca61b"
    assert parsed.tags == ["kd_017001003003", "kd_017004001004", "kd_017004002003"]
    assert one(lambda a, b: text.tags_to_json(a, b), "x", "y") == '{"c0":"x","c1":"y"}'


def test_join_fields(spark):
    df = spark.createDataFrame([("a", None, 1)], "x string, y string, z int")
    assert df.select(text.join_fields(df.columns, "|")).first()[0] == "a|null|1"


@pytest.mark.parametrize("n, ok", [(19, False), (20, True)])
def test_min_length(one, n, ok):
    assert one(text.min_length, "x" * n) is ok
