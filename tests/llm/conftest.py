import pytest

KIND = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from texts; ids count from 0. Extra columns have names that operators use themselves."""

    def build(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", f"src{k % 3}", None if t is None else len(t), 7, "x", "y")
                for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
        return spark.createDataFrame(rows, KIND + ", n_tokens long, spans string, row string")

    return build


LONG = "lorem ipsum dolor sit amet " * 20_000
ODD = [None, "", " \n\t ", "one", "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich", LONG, LONG, "日本語 のテキスト", "a" * 50_000]
