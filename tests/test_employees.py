import datetime

import pytest

from shiftroll.operators import employees as E

DAY = datetime.date
COLUMNS = (
    "employeeno int, employeeid_f01 int, surname_f02 string, givennames_f21 string, identity_f12 string, "
    "birthdate_d930 date, engagedate_d931 date, dischargedate_d932 date, title_f28 string, occupation_f11 string, "
    "category_f13 string, taxcountrycode_f14 string, gender_f22 string, emailaddress_f40 string, taxdependants_f08 int"
)


def person(number, **given):
    row = {
        "employeeno": number, "employeeid_f01": 1000 + number, "surname_f02": "S", "givennames_f21": "G",
        "identity_f12": "ID", "birthdate_d930": DAY(1980, 1, 2), "engagedate_d931": DAY(2020, 3, 4),
        "dischargedate_d932": None, "title_f28": "Mx", "occupation_f11": "O", "category_f13": "C",
        "taxcountrycode_f14": "", "gender_f22": "", "emailaddress_f40": "a@b.c", "taxdependants_f08": 0,
    }
    return tuple({**row, **given}.values())


@pytest.fixture
def legacy(spark):
    return spark.createDataFrame(
        [
            person(10, gender_f22="Male", taxcountrycode_f14="za"),
            person(9, gender_f22="f", taxcountrycode_f14="Kenya", emailaddress_f40=""),
            person(7, gender_f22=None, dischargedate_d932=DAY(2024, 5, 6), emailaddress_f40=None),
            person(8, gender_f22=""),
        ],
        COLUMNS,
    )


def test_stage(legacy, rows):
    staged = E.stage_employees(legacy)
    assert len(staged.columns) == 16
    assert rows(staged, "legacy_empno", "gender", "nationality_country_code", "email", "terminated_at") == [
        ("10", "male", "ZA", "a@b.c", None),
        ("7", "unspecified", None, "1007@migrated.invalid", "2024-05-06"),
        ("8", "unspecified", None, "a@b.c", None),
        ("9", "female", "KEN", "1009@migrated.invalid", None),
    ]
    first = staged.first()
    assert (first["hired_at"], first["date_of_birth"], first["currency"]) == ("2020-03-04", "1980-01-02", 1)


def test_mint_and_fan_out(spark, legacy, params, rows):
    minted = E.mint_users(E.stage_employees(legacy), 500, params)
    assert rows(minted.idmap) == [("10", 501), ("7", 502), ("8", 503), ("9", 504)]
    assert rows(minted.users, "id", "password_hash", "is_active") == [(i, "!migrated-no-login", 1) for i in range(501, 505)]

    known = spark.createDataFrame([("1007",)], "employee_code string")
    built = E.build_employees(minted.rows, known, params)
    assert rows(built, "id", "user_id") == [("emp-10", 501), ("emp-8", 503), ("emp-9", 504)]
    assert len(built.columns) == 20

    # the children of a skipped employee are written all the same
    contracts = E.build_contracts(minted.rows, 40, params)
    assert rows(contracts, "id", "employee_id", "rate_minor") == [(41 + i, 501 + i, 0) for i in range(4)]
    assert E.build_assignments(minted.rows, 0, params).count() == 4
    status = E.build_status(minted.rows, 0, params)
    assert rows(status, "id", "employee_id", "status", "effective_from") == [
        (1, 501, "active", "2020-03-04"),
        (2, 502, "active", "2020-03-04"),
        (3, 502, "terminated", "2024-05-06"),
        (4, 503, "active", "2020-03-04"),
        (5, 504, "active", "2020-03-04"),
    ]


def test_stored_map_gives_the_same_ids(legacy, params, rows):
    staged = E.stage_employees(legacy)
    minted = E.mint_users(staged, 0, params)
    again = E.attach_ids(staged, minted.idmap)
    assert rows(E.build_contracts(again, 5, params)) == rows(E.build_contracts(minted.rows, 5, params))


def test_second_load_skips_employees(legacy, params):
    minted = E.mint_users(E.stage_employees(legacy), 0, params)
    first = E.build_employees(minted.rows, None, params)
    assert E.build_employees(minted.rows, first, params).count() == 0
