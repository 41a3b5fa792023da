"""What Python workers keep from task to task."""
from marketlens.llm import common
from marketlens.llm.token_counts import encoder, tokenizer_path


def test_another_operator_forgets_the_encoder_and_its_own_keeps_it():
    one = encoder(tokenizer_path())
    assert list(common.lean(lambda b: (x + 1 for x in b), "tokens")(iter([1, 2]))) == [2, 3]
    assert encoder(tokenizer_path()) is one
    assert list(common.lean(lambda b: (x for x in b))(iter([]))) == []
    assert encoder(tokenizer_path()) is not one
