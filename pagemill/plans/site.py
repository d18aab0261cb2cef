"""The workflow used by the registered queries over the ``pages`` table.

A request step (default headers), a link step (all nav links, zipped with
anchor text and the page heading) and a terminal data step. A cap on the links
is a feature of a rule (``maxLinks``) and set only where that is what is asked.
"""

from __future__ import annotations

import copy

from pagemill.config import parse_config

SITE_CONFIG = {
    "taskInfo": {"id": "site", "name": "site crawl", "baseUrl": "", "concurrency": 8,
                 "requestInterval": 0},
    "workflowSteps": [
        {"id": 1, "type": "request",
         "config": {"url": "", "method": "GET", "headersMode": "json",
                    "headersJson": "{\"User-Agent\": \"pagemill\"}"}},
        {"id": 2, "type": "link_extraction",
         "config": {"linkExtractionRules": [
             {"fieldName": "link", "expression": "//nav//a/@href", "extractType": "xpath"},
             {"fieldName": "anchor", "expression": "//nav//a/text()", "extractType": "xpath"},
             {"fieldName": "section", "expression": "//h1/text()", "extractType": "xpath"},
         ]}},
        {"id": 3, "type": "data_extraction",
         "config": {"extractionRules": [
             {"fieldName": "title", "expression": "//title/text()", "extractType": "xpath"},
             {"fieldName": "content", "expression": "//article/p", "extractType": "xpath",
              "multiple": True},
         ]}},
    ],
}

# rules used by the single-rule queries
PAGE_RULES = {
    "title": {"fieldName": "title", "expression": "//title/text()"},
    "h1": {"fieldName": "h1", "expression": "//h1/text()"},
    "h1_css": {"fieldName": "h1", "expression": "article h1::text", "extractType": "css"},
    "h1_element": {"fieldName": "h1_html", "expression": "//h1"},
    "ad_element": {"fieldName": "ad_html", "expression": "//div[@class='ad']"},
    "n_paragraphs": {"fieldName": "n_paragraphs", "expression": "count(//article/p)"},
    "nav_links": {"fieldName": "link", "expression": "//nav//a/@href", "multiple": True},
    "nav_links_css": {"fieldName": "link", "expression": "nav a::attr(href)",
                      "extractType": "css", "multiple": True},
    "lang": {"fieldName": "lang", "expression": "/html/@lang"},
}


def site_workflow(max_links: int | None = None):
    """The workflow; ``max_links`` sets the link rule's cap."""
    if max_links is None:
        return parse_config(SITE_CONFIG)
    config = copy.deepcopy(SITE_CONFIG)
    config["workflowSteps"][1]["config"]["linkExtractionRules"][0]["maxLinks"] = max_links
    return parse_config(config)
