"""The worked jobs on small files of our own, with every rule at its edge."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millstream.functions.text import pair_text
from millstream.plans import attendance, cards, layouts, loans, sales, words
from millstream.sources import create, read_messages, to_messages


def lines(spark, text):
    return create(spark, text.strip().split("\n"), "value string")


DEPT = """
1,Kim,100,Accounts,1-01-2019
1,Kim,100,Accounts,2-01-2019
2,Al,200,Accounts,1-01-2019
3,Bartholomew,300,Accounts,1-01-2019
4,Joe,400,HR,1-01-2019
5,Joe,500,Accounts,1-01-2019
6,Maximilian,600,Accounts,1-01-2019
"""


def test_attendance_in_three_ways(spark):
    records = layouts.department_rows(lines(spark, DEPT))
    expected = [("Al", 1), ("Bartholomew", 1), ("Joe", 1), ("Kim", 2), ("Maximilian", 1)]
    assert rows(attendance.attendance_count(records)) == expected
    assert rows(attendance.attendance_by_groups(records)) == expected
    in_accounts = records.where("dept = 'Accounts'")
    assert rows(attendance.label_counts(in_accounts, "name")) == expected


def test_attendance_lines(spark):
    counts = attendance.attendance_count(layouts.department_rows(lines(spark, DEPT)), "HR")
    assert rows(counts.select(pair_text("name", "n"))) == [("('Joe', 1)",)]


def test_branches(spark):
    records = layouts.department_rows(lines(spark, DEPT))
    merged = attendance.departments_merged(records, ["Accounts", "HR"])
    assert ("Joe", "HR", 1) in rows(merged) and ("Joe", "Accounts", 1) in rows(merged)
    assert rows(attendance.frequent_names(records, ["Accounts", "HR"], 1)) == [
        ("Kim", 2, "Employee")]


def test_exclusions_and_length_bounds(spark):
    records = layouts.department_rows(lines(spark, DEPT))
    excluded = create(spark, ["1", "9"], "id string")
    got = attendance.attendance_with_exclusions(records, excluded)
    assert rows(got) == [("5", "Joe", 1), ("6", "Maximilian", 1)]
    unbounded = attendance.attendance_with_exclusions(records, excluded, upper=None)
    assert ("3", "Bartholomew", 1) in rows(unbounded)


def test_names_by_kind(spark):
    names = create(spark, ["Ki", "Kimberley", "Al", "Anna", "Annie", ""], "name string")
    got = dict((r["name"], r["tag"]) for r in attendance.names_by_kind(names).collect())
    assert got == {"Ki": "K", "Kimberley": "K", "Al": "Short_Names", "Anna": "Short_Names",
                   "": "Short_Names", "Annie": "Long_Names"}


def test_salary_per_employee(spark):
    from millstream.functions.numbers import to_int

    records = layouts.department_rows(lines(spark, DEPT)).withColumn("salary", to_int("salary"))
    got = attendance.salary_per_employee(records).select("employee.*", "total")
    assert ("1", "Kim", 200) in rows(got) and ("4", "Joe", 400) in rows(got)


def test_employees_with_locations(spark):
    from millstream.operators import cogroup

    places = create(spark, ["1,Pune,2nd floor", "9,Goa", "1,Delhi"], "value string")
    groups = cogroup({"dep_data": layouts.keyed_rows(lines(spark, DEPT)),
                      "loc_data": layouts.keyed_rows(places)}, ["key"])
    got = {r["key"]: (len(r["dep_data"]), sorted(f["row"][0] for f in r["loc_data"]))
           for r in groups.collect()}
    assert got["1"] == (2, [["Delhi"], ["Pune", "2nd floor"]])
    assert got["9"] == (0, [["Goa"]]) and got["2"] == (1, [])


def test_word_count(spark):
    text = create(spark, ["..The cat, the CAT", "", "cat's 9 lives-"], "value string")
    counts = words.word_count(text)
    assert rows(counts) == [
        ("CAT", 1), ("The", 1), ("cat", 2), ("lives", 1), ("s", 1), ("the", 1)]
    assert ("cat, 2",) in rows(words.word_lines(counts))


CARDS = """
C1,Ann,Lee,R1,Gold,1000,100,0,70,x
C2,Bob,Ray,R2,Gold,1000,1000,0,999,x
C3,Cy,Fox,R3,Gold,1000,1000,0,100,x
C3,Cy,Fox,R3,Gold,1000,100,0,69.99,x
C4,Di,Orr,R4,Gold,1000,1000,0,1000,x
C5,Ed,Poe,R5,Gold,1000,1001,0,500,x
"""


@pytest.mark.parametrize("bonus,points", [
    (True, [0, 1, 4, 0, 3]), (False, [0, 1, 3, 0, 2])])
def test_card_points(spark, bonus, points):
    got = cards.card_defaulters(layouts.card_rows(lines(spark, CARDS)), bonus)
    assert [r[-1] for r in rows(got)] == points
    assert ("C1 Ann Lee 0",) in rows(cards.defaulter_lines(got))


def test_cards_from_file_to_file(spark, scratch, tmp_path):
    from millstream.sinks import write_text
    from millstream.sources import read_text

    (tmp_path / "cards.txt").write_text("a,b,c,d,e,f,g,h,i,j\r\n" + CARDS.strip().replace("\n", "\r\n"))
    found = layouts.card_rows(read_text(spark, str(tmp_path), skip_header_lines=1))
    path = scratch("points")
    write_text(cards.defaulter_lines(cards.card_defaulters(found)), path, num_shards=1)
    assert ("C5 Ed Poe 3",) in rows(read_text(spark, path))


def loan(person, category, due, paid):
    return f"{person},F{person},L{person},X,7,{category},{due},100, {paid} "


def monthly(person, missed=(), late=(), category="Personal Loan"):
    return [
        loan(person, category, f"05-{m:02}-2019", f"{'06' if m in late else '05'}-{m:02}-2019")
        for m in range(1, 13) if m not in missed]


def loan_flags(spark, rows_):
    return loans.late_flags(layouts.loan_rows(create(spark, rows_, "value string")))


def people(df):
    return sorted(r["customer_id"] for r in df.collect())


def test_medical_rule(spark):
    flags = loan_flags(spark, monthly("A", late=(1, 5), category="Medical Loan")
                       + monthly("B", late=(1, 5, 9), category="Medical Loan")
                       + monthly("C", late=(1, 5, 9)))
    assert people(loans.medical_defaulters(flags)) == ["B"]


def test_personal_rule_at_both_limits(spark):
    flags = loan_flags(spark, monthly("three", missed=(1, 4, 8))
                       + monthly("four", missed=(1, 4), late=(8, 11))
                       + monthly("five", missed=(1, 3, 5, 7, 9))
                       + monthly("pair", missed=(6,), late=(7,))
                       + monthly("december", missed=(12,), late=(11,))
                       + monthly("ends", missed=(1, 12))
                       + monthly("none"))
    assert people(loans.personal_defaulters(flags)) == ["december", "five", "four", "pair"]
    assert people(loans.personal_defaulters(flags, min_missed=5)) == ["december", "five", "pair"]


def test_latest_record_of_a_month_counts(spark):
    late_then_paid = [loan("A", "P", "05-03-2018", "09-03-2018")] + monthly("A", missed=(4,))
    paid_then_late = [loan("B", "P", "06-03-2019", "09-03-2019")] + monthly("B", missed=(4,))
    flags = loan_flags(spark, late_then_paid + paid_then_late)
    for shuffled in (flags, flags.orderBy(F.desc("due_date")), flags.repartition(5)):
        assert people(loans.personal_defaulters(shuffled)) == ["B"]
    months = {r["customer_id"]: r["missed"] for r in loans.month_flags(flags).collect()}
    assert months["A"][2:4] == [0, 1] and months["B"][2:4] == [1, 1]


def test_dates_before_1970_are_packed_in_order(spark):
    flags = loan_flags(spark, [loan("A", "P", "05-03-1960", "09-03-1960"),
                               loan("A", "P", "05-03-1961", "05-03-1961")])
    assert loans.month_flags(flags).collect()[0]["missed"][2] == 0


def test_all_defaulters_names_once_per_rule(spark):
    flags = loan_flags(spark, monthly("A", late=(1, 5, 9), category="Medical Loan")
                       + monthly("A", missed=(2, 3)) + monthly("B"))
    assert rows(loans.all_defaulters(flags)) == [("A FA LA",), ("A FA LA",)]
    alone = loan_flags(spark, monthly("M", late=(1, 2, 3), category="Medical Loan"))
    assert rows(loans.all_defaulters(alone)) == [("M FM LM",)]


def test_payments_per_person_are_all_there(spark):
    got = loans.payments_per_person(loan_flags(spark, monthly("A", late=(3,)))).collect()
    assert len(got) == 1
    assert sum(p["times"] for p in got[0]["payments"]) == 12
    assert sum(p["value"]["late"] * p["times"] for p in got[0]["payments"]) == 1


SALES = """
S1,Mumbai,P1,Toys,2,10,15,100
S1,Mumbai,P2,Food,1,20,10,104
S2,Bangalore,P1,Toys,3,10,15,105
S3,Pune,P1,Toys,9,10,15,101
S2,Bangalore,P2,Food,4,10,11,114
S1,Mumbai,P1,Toys,1,10,12,99
"""


def sale_messages(spark, text=SALES):
    numbered = spark.createDataFrame(
        [(i, f" {line}\r\n") for i, line in enumerate(text.strip().split("\n"))],
        "i bigint, line string")
    return to_messages(
        numbered, F.encode("line", "UTF-8"), message_id=F.col("i"),
        publish_time=F.timestamp_seconds(F.lit(1000) + F.col("i") * 5))


def test_sales_in_windows(spark):
    messages = sale_messages(spark).withColumn("element_time", F.col("publish_time"))
    kept = sales.sales_from_messages(messages)
    assert [r["profit"] for r in kept.orderBy("element_time").collect()] == [10, -10, 15, 4, 2]

    def totals(df, *keys):
        return rows(df.select(F.unix_seconds("window_start"), *keys))

    by_event = sales.profit_by_fixed_window(sales.with_event_time(kept))
    assert sorted(totals(by_event, "store_id", "total")) == [
        (95, "S1", 2), (100, "S1", 0), (105, "S2", 15), (110, "S2", 4)]
    by_arrival = sales.profit_by_fixed_window(kept)
    assert totals(by_arrival, "store_id", "total") == [
        (1000, "S1", 10), (1005, "S1", -10), (1010, "S2", 15), (1020, "S2", 4), (1025, "S1", 2)]
    sliding = sales.profit_by_sliding_window(kept)
    assert (1005, "S1", -10) in totals(sliding, "store_id", "total")
    assert (1000, "S1", 0) in totals(sliding, "store_id", "total")
    sessions = sales.pieces_by_session(kept)
    # Toys at 1000, 1010 (exactly one gap later) and 1025; Food at 1005 and 1020
    assert totals(sessions, "product_category", "total") == [
        (1000, "Toys", 2), (1005, "Food", 1), (1010, "Toys", 3), (1020, "Food", 4),
        (1025, "Toys", 1)]
    assert rows(sales.profit_by_panes(kept)) == []
    payloads = by_arrival.select(F.decode(sales.result_payload("store_id"), "UTF-8"))
    assert ("('S2', 15)",) in rows(payloads)


def test_bad_sale_stops_or_is_dropped(spark):
    text = "S1,Mumbai,P1,Toys,2,10,15\nS1,Mumbai,P1,Toys,two,10,15"
    messages = sale_messages(spark, text).withColumn("element_time", F.col("publish_time"))
    with pytest.raises(Exception, match="not an integer"):
        sales.sales_from_messages(messages).collect()
    assert sales.sales_from_messages(messages, on_error="drop").count() == 1


@pytest.mark.parametrize("read,bad", [
    (layouts.department_rows, "1,Kim,100"), (layouts.card_rows, CARDS.strip() + ",more"),
    (layouts.loan_rows, "A,B,C"), (layouts.sale_rows, "S1,Mumbai,P1,Toys,2,10"),
    (layouts.sale_rows, "S1,Mumbai,P1,Toys,2,10,15,soon")])
def test_malformed_lines_stop_the_job(spark, read, bad):
    with pytest.raises(Exception, match="wrong number of fields|not an integer"):
        read(lines(spark, bad)).collect()
    if "soon" not in bad:
        kept = read(lines(spark, bad), on_error="drop" if read is layouts.sale_rows else "null")
        assert kept.count() == bad.count("\n")


def test_message_without_time_is_kept(spark):
    from millstream.sources.topics import first_per_id

    df = spark.createDataFrame([("a", None, 1), ("b", 5, 2), ("b", 4, 3)], "i string, t int, v int")
    assert rows(first_per_id(df, ["i"], F.col("t"))) == [("a", None, 1), ("b", 4, 3)]


def test_message_reading_rules(spark, scratch):
    from millstream.sinks import publish
    from millstream.sources.topics import kafka_options, topic_parts

    topic = f"dir:{scratch('topic')}"
    publish(to_messages(
        spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "2")], "d string, i string"),
        F.encode("d", "UTF-8"), message_id=F.col("i"), id_label="uid",
        publish_time=F.timestamp_seconds(F.lit(1000)) + F.expr("INTERVAL 1 SECOND") * F.ascii("d"),
        attributes={"sent": F.lit("1500")}, timestamp_attribute="ts"), topic)
    plain = read_messages(spark, topic=topic, streaming=False)
    assert plain.columns == ["data", "element_time"] and plain.count() == 3
    full = read_messages(spark, topic=topic, streaming=False, with_attributes=True,
                         timestamp_attribute="sent")
    assert {r["s"] for r in full.select(F.unix_millis("element_time").alias("s")).collect()} == {1500}
    stamped = full.select((F.unix_millis("publish_time").cast("string")
                           == F.col("attributes")["ts"]).alias("same"))
    assert rows(stamped) == [(True,)] * 3
    unique = read_messages(spark, topic=topic, streaming=False, id_label="uid")
    assert sorted(bytes(r["data"]) for r in unique.collect()) == [b"a", b"c"]
    for both in ({}, {"topic": topic, "subscription": topic}):
        with pytest.raises(ValueError):
            read_messages(spark, **both)
    with pytest.raises(ValueError):
        topic_parts("/plain/path")
    assert kafka_options("t/g@h:1", True) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "kafka.group.id": "g"}
