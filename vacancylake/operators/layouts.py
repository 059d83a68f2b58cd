"""Where each source's pages keep their fields.

A layout is data: one extraction job serves all of them, and a further source
is a further entry. All tags and class names are fixed values.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from vacancylake.functions.markup import Step


@dataclass(frozen=True)
class Field:
    """How to read one value: the ways are tried in order until one leads somewhere."""

    ways: tuple[tuple[Step, ...], ...]
    take: str = "text"  # text | joined | lines | present | an attribute name
    every: bool = False  # all elements the last step matches, as a list


@dataclass(frozen=True)
class Layout:
    root: tuple[Step, ...]
    rows: Step | None = None  # None: the page itself is the one record
    skip: int = 0
    needs: tuple[tuple[Step, str], ...] = ()  # elements a row must have, and what to say when it has not
    some: tuple[str, ...] = ()  # fields of which a row must have one, else it has no content
    fields: dict[str, Field] = field(default_factory=dict)

    @cached_property
    def plan(self) -> tuple[list, list, list]:
        """The steps below a row as a tree, each with the number of the one before it (-1: the row), and needs and fields by its numbers."""
        steps: list[tuple[int, Step]] = []
        number: dict[tuple[int, Step], int] = {}

        def node(way: tuple[Step, ...]) -> int:
            at = -1
            for step in way:
                if (at, step) not in number:
                    number[at, step] = len(steps)
                    steps.append((at, step))
                at = number[at, step]
            return at

        needs = [(node((step,)), why) for step, why in self.needs]
        fields = [
            (name, [(node(way[:-1]), way[-1]) if f.every else (node(way), None) for way in f.ways], f.take)
            for name, f in self.fields.items()
        ]
        return steps, needs, fields


def _at(*steps: Step, take: str = "text", every: bool = False) -> Field:
    return Field((steps,), take, every)


def _cell(n: int) -> Step:
    return Step("td", at=n)


LISTING_LAYOUTS: dict[str, Layout] = {
    "jobs_ge": Layout(
        root=(Step("*", id="job_list_table"),),
        rows=Step("tr"),
        skip=1,
        needs=((_cell(5), "fewer than 6 cells"),),
        fields={
            "title": _at(_cell(1), Step("a")),
            "href": _at(_cell(1), Step("a"), take="href"),
            "place": _at(_cell(1), Step("i")),
            "icons": _at(_cell(1), Step("img"), take="src", every=True),
            "logo": _at(_cell(2), Step("a"), Step("img"), take="src"),
            "company": _at(_cell(3), Step("a")),
            "company_href": _at(_cell(3), Step("a"), take="href"),
            "published": _at(_cell(4)),
            "deadline": _at(_cell(5)),
        },
    ),
    "cv_ge": Layout(
        root=(Step("div", cls="item-listing"),),
        rows=Step("div", cls="list-item"),
        needs=((Step("p", cls="list-item-title"), "no title"),),
        fields={
            "title": _at(Step("p", cls="list-item-title"), Step("a", cls="announcement-list-item")),
            "href": _at(Step("p", cls="list-item-title"), Step("a", cls="announcement-list-item"), take="href"),
            "place": _at(Step("span", cls="list-item-tag item-badge")),
            "company": _at(Step("a", cls="list-item-company")),
            "company_href": _at(Step("a", cls="list-item-company"), take="href"),
            "period": _at(Step("span", cls="list-item-time"), take="joined"),
            "marker": _at(Step("p", cls="list-item-location")),
        },
    ),
    "ss_ge": Layout(
        root=(),
        rows=Step("div", cls="sc-28f268a4-2 udaGZ"),
        needs=((Step("h2", part="title"), "no title"),),
        fields={
            "title": _at(Step("h2", part="title")),
            "href": Field(((Step("a", around=True),), (Step("a"),)), "href"),
            "price": _at(Step("span", part="price")),
            "experience": _at(Step("span", cls="sc-64e43013-0 jMGSUP")),
            "spans": _at(Step("span", cls="sc-64e43013-0 jMGSUP"), every=True),
            "description": _at(Step("div", part="sc-28f268a4-1")),
            "marker": _at(Step("div", part="sc-28f268a4-5")),
        },
    ),
}

DETAIL_LAYOUTS: dict[str, Layout] = {
    "cv_ge": Layout(
        root=(),
        needs=((Step("div", cls="entry-content"), "no content"),),
        fields={
            "body": _at(Step("div", cls="entry-content"), take="lines"),
            "links": _at(Step("a"), take="href", every=True),
            "company": _at(Step("aside", cls="widget_ci-company-info-widget"), Step("p", cls="card-info-title")),
        },
    ),
    "jobs_ge": Layout(
        root=(),
        some=("title", "body"),
        fields={
            "title": _at(Step("h1")),
            "body": Field(((Step("div", cls="job-description"),), (Step("div", id="job_description"),)), "joined"),
            "company": _at(Step("div", cls="company-info"), Step("a")),
            "salary_box": _at(Step("div", cls="salary"), take="present"),
        },
    ),
}
