import pytest

from bugsieve.llm import licenses


@pytest.mark.parametrize("inserted", [10, 20, 30])
def test_inserted_words_at_any_offset(inserted):
    scanner = licenses.Scanner({"mit": licenses.TEMPLATES["mit-permission"]})
    notice = licenses.TEMPLATES["mit-permission"].split()
    middle = len(notice) // 2
    changed = notice[:middle] + [f"new{i}" for i in range(inserted)] + notice[middle:]
    for offset in range(120):
        words = [f"before{i}" for i in range(offset)] + changed + [f"after{i}" for i in range(200)]
        assert scanner.scan(" ".join(words)) == [("mit", 21 / 25, offset)], offset
