"""Cards of a page are handed on before those of later pages are read."""

import json

import pyarrow as pa

from tallymart.sources import cards


def test_cards_leave_in_small_batches():
    """One batch of pages used to become one column of all their cards."""
    card = {cards.CARD_KEY: "n", "x.on-tap": {"action": {"parameters": {"restaurant_id": "r"}}}}
    state = json.dumps({"feed": [card] * 1500})
    read = iter(cards._placed(iter([pa.RecordBatch.from_pydict({"page_id": list(range(10)), "state": [state] * 10})])))
    sizes = [b.num_rows for b in read]
    assert sum(sizes) == 15000 and max(sizes) <= cards.MOST_CARDS
