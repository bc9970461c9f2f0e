"""Target weights of the training mixture."""

from lumbung.llm.mixing import Targets

WEB, BOOKS, NEWS = "web", "books", "news"

#: Half of the tokens from the web, the rest from books and news; English as much as two other languages.
TARGETS = Targets(
    domains={f"src{i}": WEB if i < 8 else BOOKS if i < 14 else NEWS for i in range(20)},
    domain={WEB: 50, BOOKS: 30, NEWS: 20},
    lang={"en": 40, "de": 20, "fr": 20, "es": 20},
    share=800,
    epochs=4,
)
