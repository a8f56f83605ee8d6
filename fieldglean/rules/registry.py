"""What each state register shows where: owners, entity, agent, status, search hits.

All values in this file are fixed by the pages themselves.

A state has page fields and rows. ``owner`` rows may be filtered by a ``label`` or ``status`` cell of
the same row; ``agent`` rows stand in when there is no owner. The settings of a state say what the
label or status must be, how many rows count, and what the page must show at all.
"""

from __future__ import annotations

from functools import cache

from fieldglean.rules.sites import rule, steps

# States that are searched. Arizona and Illinois have rules too but are switched off.
STATES = [
    "Alabama", "Arkansas", "California", "Colorado", "Connecticut", "Florida", "Texas", "New York", "North Carolina",
    "Michigan", "Delaware", "Hawaii", "Idaho", "Iowa", "Indiana", "Kansas", "Kentucky", "Louisiana", "Maine",
    "Mississippi", "Massachusetts", "Montana",
]

# owner_label / agent_label: what the label cell of the row must say.   status: what the status cell must say.
# limit: rows that count, taken after the filters.   guard: what the page must say, one of several.
# needs_entity: no result without an entity.   fallback: result when owners and agent are missing.
# drop: text that is no owner.   entity_label: row whose value is the entity.   joined: entity and owner form a pair.
SETTINGS = {
    "Alabama": {"owner_label": "Registered Agent Name", "limit": 1},
    "Arkansas": {"owner_label": "Reg. Agent", "limit": 1},
    "California": {"limit": 5},
    "Colorado": {"owner_label": "Name", "limit": 1, "guard": ["Registered Agent"]},
    "Connecticut": {"status": "ACTIVE", "limit": 5, "drop": "View all"},
    "Florida": {"limit": 1},
    "Texas": {"owner_label": "Registered Agent Name", "limit": 1},
    "Arizona": {},
    "Illinois": {"owner_label": "Agent Information", "limit": 1},
    "New York": {"limit": 1, "joined": True},
    "North Carolina": {"joined": True, "needs_entity": True, "fallback": ""},
    "Michigan": {"limit": 1, "joined": True, "needs_entity": True, "fallback": ""},
    "Delaware": {"limit": 1, "joined": True, "needs_entity": True, "fallback": ""},
    "Hawaii": {"joined": True, "needs_entity": True, "owner_guard": ["Member/MGR", "Officers"], "agent_label": "AGENT NAME",
               "fallback": "NOT FOUND"},
    "Idaho": {"limit": 3, "joined": True},
    "Indiana": {"joined": True, "needs_entity": True, "agent_label": "Registered Agent Information"},
    "Iowa": {"limit": 1, "joined": True},
    "Kansas": {"limit": 1, "joined": True, "guard": ["Current Status: ACTIVE AND IN GOOD STANDING"]},
    "Kentucky": {"owner_label": "Registered Agent", "entity_label": "Name", "joined": True, "fallback": ""},
    "Louisiana": {"limit": 5, "joined": True, "guard": ["Active"]},
    "Maine": {"limit": 1, "joined": True},
    "Mississippi": {"joined": True, "needs_entity": True, "compact": True},
    "Massachusetts": {"limit": 1, "joined": True},
    "Montana": {"limit": 1, "joined": True},
}

_CT = ('//*[@id="ServiceCommunityTemplate"]/div[1]/div/div[2]/div/div/div/div/div/div/div/section/div/div[2]/div/div/div/'
       "c-brs_-business-search/div/div/div[2]")
_TABLE = '//*[@id="root"]/div/div[1]/div/main/div[2]/table/tbody/tr'
_NY = '//*[@id="app"]/div/main/div/div/div[2]'
_NC = '//*[@id="filings-article"]/section'


def _owner(state: str, xpath: str, row: str = "", label: str | None = None, status: str | None = None, entity: str | None = None,
           mode: str = "own", part: str = "owner", skip_first: int = 0, priority: int = 1) -> list[dict]:
    depth = steps(row)
    cells = {part: (xpath, mode), f"{part}_label": (label, "own"), "status": (status, "own"), "row_entity": (entity, "own")}
    return [rule(state, field, x, part=part, mode=m, depth=depth, skip_first=skip_first, priority=priority)
            for field, (x, m) in cells.items() if x]


@cache
def owner_rules() -> tuple[dict, ...]:
    page = lambda state, field, xpath, mode="own": rule(state, field, xpath, part="page", mode=mode)
    rows: list[dict] = []
    tr = '//*[@id="block-sos-content"]/div/div/div/table[2]/tbody[1]/tr'
    rows += _owner("Alabama", f"{tr}/td[2]", tr, f"{tr}/td[1]")
    rows += _owner("Arizona", "/html/body/div[1]/div/div[14]/div[2]")
    tr = '//*[@id="mainContent"]/table[2]/tbody[1]/tr'
    rows += _owner("Arkansas", f"{tr}/td[2]/font[1]", tr, f"{tr}/td[1]/font[1]")
    rows += _owner("California", f"{_TABLE}/td[6]/span[1]", _TABLE)
    rows += [page("California", "none", '//*[@id="root"]/div/div[1]/div/main/div[2]/svg', "@@")]
    tr = ('//*[@id="application"]/table/tbody/tr/td[2]/table/tbody/tr[3]/td/form/table[1]/tbody/tr[1]/td/table/tbody/tr[7]/td/'
          "table/tbody/tr")
    rows += _owner("Colorado", f"{tr}/td[2]", tr, f"{tr}/td[1]", skip_first=1)
    rows += [page("Colorado", "guard", f"{tr}[1]/th[1]")]
    card = f"{_CT}/c-brs_business-detail-card[1]/div"
    status = f"{card}/div[1]/div[1]/div[2]/span[1]/c-brs_badges[1]/span[1]"
    rows += _owner("Connecticut", f"{card}/div[2]/div[1]/div[1]/div[1]/p", card, status=status)
    rows += [page("Connecticut", "none", f"{_CT}/c-brs_no-data-card", "@@")]
    rows += _owner("Florida", '//*[@id="maincontent"]/div[2]/div[5]/span[2]')
    rows += _owner("Texas", '//*[@id="trDetailsBody"]/tr/td[2]', '//*[@id="trDetailsBody"]/tr', '//*[@id="trDetailsBody"]/tr/td[1]/b[1]')
    rows += _owner("Illinois", "/html/body/div/div[3]/div/div[2]/div[1]/div[1]", "/html/body/div/div[3]/div", "/html/body/div/div[3]/div/div[1]/h3[1]")
    rows += _owner("New York", f"{_NY}/div[3]/div[4]/div/div[2]/div[1]/div/span[2]")
    rows += [page("New York", "entity", f"{_NY}/div[1]/div[2]/div/div/div/div/div/div[1]/span/span[2]")]
    rows += _owner("North Carolina", f"{_NC}/section[4]/p/span[2]/a[1]", f"{_NC}/section[4]/p", mode="content")
    rows += _owner("North Carolina", f"{_NC}/section[2]/div/span[last()]/a[1]", part="agent")
    rows += [page("North Carolina", "entity", f"{_NC}/section[1]/div/span[2]")]
    rows += _owner("Michigan", '//*[@id="MainContent_lblResidentAgentName"]')
    rows += [page("Michigan", "entity", '//*[@id="MainContent_lblEntityNameHeader"]')]
    rows += _owner("Delaware", '//*[@id="ctl00_ContentPlaceHolder1_lblAgentName"]')
    rows += [page("Delaware", "entity", '//*[@id="ctl00_ContentPlaceHolder1_lblEntityName"]')]
    rows += _owner("Hawaii", '//*[@id="officersTable"]/tbody/tr/td[1]', '//*[@id="officersTable"]/tbody/tr')
    agent = '//*[@id="general"]/section[1]/div[2]/div[2]/dl'
    rows += _owner("Hawaii", f"{agent}/dd", f"{agent}/dd", f"{agent}/dt", part="agent")
    rows += [page("Hawaii", "entity", '//*[@id="body-container"]/main/div[1]/div[1]/h1'),
             page("Hawaii", "owner_guard", '//*[@id="general"]/section[3]/h2')]
    rows += _owner("Idaho", f"{_TABLE}/td[4]/span[1]", _TABLE, entity=f"{_TABLE}/td[1]/div[1]/span[1]")
    rows += _owner("Indiana", '//*[@id="grid_principalList"]/tbody/tr/td[2]', '//*[@id="grid_principalList"]/tbody/tr')
    tr = "/html/body/table/tbody/tr"
    rows += _owner("Indiana", f"{tr}/td/div/table/tbody/tr[3]/td[2]/strong", tr,
                   f"{tr}/td[1]/div[1]/table[1]/tbody[1]/tr[1]/td[1]", part="agent")
    rows += [page("Indiana", "entity", f"{tr}[1]/td/div/table/tbody/tr[2]/td[2]/strong")]
    article = "/html/body/div/section/article"
    rows += _owner("Iowa", f"{article}/table[3]/tbody/tr[2]/td")
    rows += [page("Iowa", "entity", f"{article}/table[1]/tbody/tr[2]/td[2]")]
    rows += _owner("Kansas", "/html/body/div[2]/p[9]")
    rows += [page("Kansas", "entity", "/html/body/div[2]/table[2]/tbody/tr[2]/td[1]"), page("Kansas", "guard", "/html/body/div[2]/p[7]")]
    tr = '//*[@id="ctl00_ContentPlaceHolder1_FTUC_pInfo"]/table/tbody/tr'
    rows += _owner("Kentucky", f"{tr}/td[3]", tr, f"{tr}/td[2]", mode="content")
    for i in range(5):
        rows += _owner("Louisiana", f'//*[@id="ctl00_cphContent_rptOfficers_ctl0{i}_lblOfficerName"]', priority=i + 1)
    rows += _owner("Louisiana", '//*[@id="ctl00_cphContent_rptAgents_ctl00_lblAgentName"]', part="agent")
    rows += [page("Louisiana", "entity", '//*[@id="ctl00_cphContent_lblName"]'), page("Louisiana", "guard", '//*[@id="ctl00_cphContent_lblStatus"]'),
             page("Louisiana", "no_agent", '//*[@id="ctl00_cphContent_pnlOfficers"]', "@@")]
    body = "/html/body/center/table/tbody/tr[3]/td/table/tbody"
    rows += _owner("Maine", f"{body}/tr[12]/td", mode="content")
    rows += [page("Maine", "entity", f"{body}/tr[5]/td[1]", "content")]
    rows += _owner("Mississippi", '//*[@id="printDiv2"]/table[3]/tbody/tr/td[1]/a[1]', '//*[@id="printDiv2"]/table[3]/tbody/tr', skip_first=1)
    rows += _owner("Mississippi", '//*[@id="printDiv2"]/table[2]/tbody/tr[2]/td/a', part="agent")
    rows += [page("Mississippi", "entity", '//*[@id="printDiv2"]/div[2]/table/tbody/tr[2]/td[1]')]
    rows += _owner("Massachusetts", '//*[@id="MainContent_lblResidentAgentName"]', mode="content")
    rows += [page("Massachusetts", "entity", '//*[@id="MainContent_lblEntityName"]', "content")]
    rows += _owner("Montana", f"{_TABLE}/td[4]/span")
    rows += [page("Montana", "entity", f"{_TABLE}/td[1]/div/span[1]"),
             page("Montana", "none", '//*[@id="root"]/div/div[1]/div/main/div[2]/p', "@@")]
    return tuple(rows)


# Search hits: which rows count. ``first`` takes the limit before the status filter.
HITS = {
    "Florida": {"status": "Active", "limit": 5, "first": True},
    "Iowa": {"status": "Active", "limit": 3},
    "Kentucky": {"limit": 3},
    "Maine": {"limit": 3},
    "Massachusetts": {"limit": 3},
    "Indiana": {"status": "Active", "limit": 1},
    "Mississippi": {"status": "Good Standing", "limit": 1},
    "Texas": {},
    "New York": {},
}
COLORADO_HITS = '//*[@id="box"]/table/tbody/tr'
COLORADO_TITLES = ["ID Number", "Status"]
COLORADO_STATUS = "Good Standing"


@cache
def hit_rules() -> tuple[dict, ...]:
    rows = []

    def hits(state: str, tr: str, skip_first: int = 0, status: str = "", href: str = "") -> None:
        cells = {"present": ("", "@@"), "status": (status, "own"), "href": (href, "@href")}
        rows.extend(rule(state, f, f"{tr}/{tail}".rstrip("/"), part="hits", mode=m, depth=steps(tr), skip_first=skip_first)
                    for f, (tail, m) in cells.items() if tail or f == "present")

    hits("Florida", '//*[@id="search-results"]/table/tbody/tr', status="td[3]")
    hits("Iowa", "/html/body/div/section/article/table/tbody/tr", 1, status="td[3]", href="td[1]/a[1]")
    hits("Kentucky", '//*[@id="ctl00_ContentPlaceHolder1_FTUC_pOrglist"]/table/tbody/tr', 1, href="td[1]/a[1]")
    hits("Maine", "/html/body/form/center/table/tbody/tr[3]/td/table[1]/tbody/tr", 5, href="td[4]/font[1]/a[1]")
    hits("Massachusetts", '//*[@id="MainContent_SearchControl_grdSearchResultsEntity"]/tbody/tr', 1, href="th[1]/a[1]")
    hits("Indiana", '//*[@id="grid_businessList"]/tbody/tr', status="td[7]")
    hits("Mississippi", '//*[@id="businessSearchResultsDiv"]/table/tbody/tr', status="td[4]")
    hits("Texas", "/html/body/div/div[3]/form/div[1]/div[1]/div[2]/div[1]/div/div/table/tbody/tr")
    hits("New York", '//*[@id="app"]/div/main/div/div/div/div[2]/div/div[1]/div/div[2]/div/div[1]/table/tbody/tr')
    return tuple(rows)


# Pages that refuse the visitor, and a dialog that is closed when its style hides it.
REFUSALS = [
    "Sorry, the page you are looking for is not available.  Please email webmaster@ilsos.gov including the Reference ID "
    "and Client IP numbers below",
    "You don't have permission to access",
]
DIALOG = ("Texas", '//*[@id="editModal"]', "display: none;")
