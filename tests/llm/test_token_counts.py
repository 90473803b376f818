import tiktoken

from turnweave.llm.token_counts import at_limits, encoding, length_histogram, quantiles, suffix_sums, with_token_counts, TOKENIZER


def test_sums_against_lists(spark):
    texts = ["", None, "a", "hello world", "hello world", "one two three four five " * 700, "é😀"]
    counted = with_token_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    encode = encoding(TOKENIZER).encode_ordinary
    lengths = sorted(len(encode(t)) if t else 0 for t in texts)
    assert sorted(r.n_tokens for r in counted.collect()) == lengths
    histogram = length_histogram(counted)
    for row in suffix_sums(histogram).collect():
        n = row.n_tokens
        assert (row.docs, row.docs_at_least) == (lengths.count(n), sum(x >= n for x in lengths))
        assert row.tokens_at_least == sum(x for x in lengths if x >= n)
        assert row.docs_up_to == sum(x <= n for x in lengths)
        assert row.truncated_tokens == sum(min(x, n) for x in lengths)
        assert (row.all_docs, row.all_tokens) == (len(lengths), sum(lengths))
    found = {r.n_tokens: r.truncated_tokens for r in at_limits(histogram, [3, 1024, 10**6]).collect()}
    assert found == {n: sum(min(x, n) for x in lengths) for n in (3, 1024, 10**6)}
    middle = quantiles(suffix_sums(histogram), [0.5, 1.0]).orderBy("fraction").collect()
    assert [r.n_tokens for r in middle] == [lengths[3], lengths[-1]]


def test_cuts_are_those_of_the_vocabulary():
    text = "It's 42 words,\n  isn't it?  ñandú"
    enc = encoding(TOKENIZER)
    assert isinstance(enc, tiktoken.Encoding) and enc.decode(enc.encode_ordinary(text)) == text


def test_odd_tables(odd, nothing):
    assert with_token_counts(odd).where("n_tokens = 0").count() == 3
    assert suffix_sums(length_histogram(with_token_counts(nothing))).count() == 0
