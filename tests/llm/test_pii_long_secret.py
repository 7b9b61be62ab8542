from campanula.llm import pii


def test_a_long_token_goes_as_a_whole(spark):
    for n in (512, 513, 5000):
        token = ("eyJhbGciOi9." * n)[:n]
        text = f"before token={token} and after"
        assert ("secret", text.index(token), text.index(token) + n) in pii.Scanner().spans(text)
        out = pii.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().text
        assert "eyJ" not in out and "hbGci" not in out and out.startswith("before token=") and out.endswith(" and after")
