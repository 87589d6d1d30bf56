"""The one configuration with domain names: per-player league statistics and transfer values.

Everything below is fixed data that results depend on (output headers, source fields, page selectors).  The library
itself takes entity, group and metric columns as arguments.
"""

from __future__ import annotations

# ---- fixed values: output headers in order, with the source field of each -------------------------------------
EXPORT_FIELDS: list[tuple[str, str]] = [
    ("Player", "player"),
    ("Nation", "nationality"),
    ("Team", "team"),
    ("Position", "position"),
    ("Age", "age"),
    ("Playing Time: matches played", "games"),
    ("Playing Time: starts", "games_starts"),
    ("Playing Time: minutes", "minutes"),
    ("Performance: goals", "goals"),
    ("Performance: assists", "assists"),
    ("Performance: yellow cards", "cards_yellow"),
    ("Performance: red cards", "cards_red"),
    ("Expected: xG", "xg"),
    ("Expected: xAG", "xg_assist"),
    ("PrgC", "progressive_carries"),
    ("PrgP", "progressive_passes"),
    ("PrgR", "progressive_passes_received"),
    ("Per 90 minutes: Gls", "goals_per90"),
    ("Per 90 minutes: Ast", "assists_per90"),
    ("Per 90 minutes: xG", "xg_per90"),
    ("Per 90 minutes: xAG", "xg_assist_per90"),
    ("Goalkeeping: Performance: GA90", "gk_goals_against_per90"),
    ("Goalkeeping: Performance: Save%", "gk_save_pct"),
    ("Goalkeeping: Performance: CS%", "gk_clean_sheets_pct"),
    ("Goalkeeping: Penalty Kicks: Save%", "gk_pens_save_pct"),
    ("Shooting: Standard: SoT%", "shots_on_target_pct"),
    ("Shooting: Standard: SoT/90", "shots_on_target_per90"),
    ("Shooting: Standard: G/Sh", "goals_per_shot"),
    ("Shooting: Standard: Dist", "average_shot_distance"),
    ("Passing: Total: Cmp", "passes_completed"),
    ("Passing: Total: Cmp%", "passes_pct"),
    ("Passing: Total: TotDist", "passes_progressive_distance"),
    ("Passing: Short: Cmp%", "passes_pct_short"),
    ("Passing: Medium: Cmp%", "passes_pct_medium"),
    ("Passing: Long: Cmp%", "passes_pct_long"),
    ("Passing: Expected: KP", "assisted_shots"),
    ("Passing: Expected: 1/3", "passes_into_final_third"),
    ("Passing: Expected: PPA", "passes_into_penalty_area"),
    ("Passing: Expected: CrsPA", "crosses_into_penalty_area"),
    ("Passing: Expected: PrgP", "progressive_passes"),
    ("Goal and Shot Creation: SCA: SCA", "sca"),
    ("Goal and Shot Creation: SCA: SCA90", "sca_per90"),
    ("Goal and Shot Creation: GCA: GCA", "gca"),
    ("Goal and Shot Creation: GCA: GCA90", "gca_per90"),
    ("Defensive Actions: Tackles: Tkl", "tackles"),
    ("Defensive Actions: Tackles: TklW", "tackles_won"),
    ("Defensive Actions: Challenges: Att", "challenges"),
    ("Defensive Actions: Challenges: Lost", "challenges_lost"),
    ("Defensive Actions: Blocks: Blocks", "blocks"),
    ("Defensive Actions: Blocks: Sh", "blocked_shots"),
    ("Defensive Actions: Blocks: Pass", "blocked_passes"),
    ("Defensive Actions: Blocks: Int", "interceptions"),
    ("Possession: Touches: Touches", "touches"),
    ("Possession: Touches: Def Pen", "touches_def_pen_area"),
    ("Possession: Touches: Def 3rd", "touches_def_3rd"),
    ("Possession: Touches: Mid 3rd", "touches_mid_3rd"),
    ("Possession: Touches: Att 3rd", "touches_att_3rd"),
    ("Possession: Touches: Att Pen", "touches_att_pen_area"),
    ("Possession: Take-Ons: Att", "take_ons"),
    ("Possession: Take-Ons: Succ%", "take_ons_won_pct"),
    ("Possession: Take-Ons: Tkld%", "take_ons_tackled_pct"),
    ("Possession: Carries: Carries", "carries"),
    ("Possession: Carries: PrgDist", "carries_progressive_distance"),
    ("Possession: Carries: 1/3", "carries_into_final_third"),
    ("Possession: Carries: CPA", "carries_into_penalty_area"),
    ("Possession: Carries: Mis", "miscontrols"),
    ("Possession: Carries: Dis", "dispossessed"),
    ("Possession: Receiving: Rec", "passes_received"),
    ("Possession: Receiving: PrgR", "progressive_passes_received"),
    ("Miscellaneous: Performance: Fls", "fouls"),
    ("Miscellaneous: Performance: Fld", "fouled"),
    ("Miscellaneous: Performance: Off", "offsides"),
    ("Miscellaneous: Performance: Crs", "crosses"),
    ("Miscellaneous: Performance: Recov", "ball_recoveries"),
    ("Miscellaneous: Aerial Duels: Won", "aerials_won"),
    ("Miscellaneous: Aerial Duels: Lost", "aerials_lost"),
    ("Miscellaneous: Aerial Duels: Won%", "aerials_won_pct"),
]
# headers the earlier edition of the wide table does not have
LATER_ONLY_HEADERS = ("Possession: Receiving: Rec", "Possession: Receiving: PrgR")

# ---- fixed values: fields taken from each stat table, base table first, then in order of application ----------
BASE_TABLE = "stats_standard"
TABLE_FIELDS: dict[str, list[str]] = {
    "stats_standard": [
        "player", "nationality", "position", "team", "age", "games", "games_starts", "minutes", "goals", "assists",
        "cards_yellow", "cards_red", "xg", "xg_assist", "progressive_carries", "progressive_passes",
        "progressive_passes_received", "goals_per90", "assists_per90", "xg_per90", "xg_assist_per90",
    ],
    "stats_keeper": ["gk_goals_against_per90", "gk_save_pct", "gk_clean_sheets_pct", "gk_pens_save_pct"],
    "stats_shooting": [
        "shots_on_target_pct", "shots_on_target_per90", "goals_per_shot", "average_shot_distance",
    ],
    "stats_passing": [
        "passes_completed", "passes_pct", "passes_progressive_distance", "passes_pct_short", "passes_pct_medium",
        "passes_pct_long", "assisted_shots", "passes_into_final_third", "passes_into_penalty_area",
        "crosses_into_penalty_area", "progressive_passes",
    ],
    "stats_gca": ["sca", "sca_per90", "gca", "gca_per90"],
    "stats_defense": [
        "tackles", "tackles_won", "challenges", "challenges_lost", "blocks", "blocked_shots", "blocked_passes",
        "interceptions",
    ],
    "stats_possession": [
        "touches", "touches_def_pen_area", "touches_def_3rd", "touches_mid_3rd", "touches_att_3rd",
        "touches_att_pen_area", "take_ons", "take_ons_won_pct", "take_ons_tackled_pct", "carries",
        "carries_progressive_distance", "progressive_carries", "carries_into_final_third",
        "carries_into_penalty_area", "miscontrols", "dispossessed", "passes_received",
        "progressive_passes_received",
    ],
    "stats_misc": [
        "fouls", "fouled", "offsides", "crosses", "ball_recoveries", "aerials_won", "aerials_lost",
        "aerials_won_pct",
    ],
}

# ---- fixed values: columns and thresholds ----------------------------------------------------------------------
ENTITY, GROUP, MINUTES, AGE = "Player", "Team", "Playing Time: minutes", "Age"
IDENTITY_COLUMNS = ["Player", "Nation", "Team", "Position", "Age"]
EARLIER_STATS_EXCLUDE = [*IDENTITY_COLUMNS, "Playing Time: matches played", "Playing Time: starts"]
CATEGORY_COLUMNS = ["Nation", "Team", "Position"]
MIN_MINUTES = 90
VALUE_MIN_MINUTES = 900
KEY_METRICS = [
    "Performance: goals", "Performance: assists", "Expected: xG", "Per 90 minutes: Gls", "Per 90 minutes: Ast",
    "Per 90 minutes: xG", "Goalkeeping: Performance: GA90", "Goalkeeping: Performance: Save%",
]
LOWEST_WINS = ["Goalkeeping: Performance: GA90"]
HISTOGRAM_METRICS = [
    "Expected: xG", "Per 90 minutes: Gls", "Shooting: Standard: SoT%", "Performance: assists",
    "Passing: Expected: KP", "Passing: Expected: PrgP",
]
EARLIER_HISTOGRAM_METRICS = ["Playing Time: matches played", "Playing Time: starts", "Performance: goals"]

# ---- fixed values: where the fields sit on listing and detail pages, (tag, classes) steps from the table cell ----
LISTING_BODY = "player-table-body"
LISTING_TEXTS = {
    "Player": [("td", "td-player"), ("div", "text"), ("a", None)],
    "Position": [("td", "td-player"), ("span", "sub-text d-none d-md-block")],
    "Age": [("td", "m-hide age")],
    "Team_Internal": [("td", "td-team"), ("span", "td-team__teamname")],
    "SkillText": [("div", "table-skill__skill")],
    "PotentialText": [("div", "table-skill__pot")],
    "ETV_Raw_Internal": [("td", "text-center"), ("span", "player-tag")],
}
LISTING_ATTRIBUTES = {
    "Nation_Internal": ([("td", "nationality"), ("span", "ficon")], "title"),
    "detail_url": ([("td", "td-player"), ("div", "text"), ("a", None)], "href"),
}
DETAIL_BLOCK = ("div", "d-col")
DETAIL_LABEL = ("span", "txt")
DETAIL_VALUE = ("span", "player-tag")
DETAIL_LABEL_TEXT = "Highest ETV"

# ---- fixed values: final value tables ----------------------------------------------------------------------------
EARLIER_VALUE_RENAMES = {
    "Team_Internal": "Team_TransferSite",
    "ETV_Raw_Internal": "TransferValueRaw",
    "ETV_Parsed": "TransferValue_EUR_Millions",
}
EARLIER_VALUE_COLUMNS = [
    "Player", "Team_TransferSite", "Age", "Position", "Skill", "Potential", "TransferValueRaw",
    "TransferValue_EUR_Millions",
]
VALUE_COLUMNS = ["Player", "Team", "Age", "Position", "TransferValue_EUR_Millions", "Highest_ETV_EUR_Millions"]
TARGET = "TransferValue_EUR_Millions"
LEAKING_COLUMN = "Highest_ETV_EUR_Millions"
ID_COLUMNS = ["Player", "Nation", "Team", "Team_TransferSite"]
# -------------------------------------------------------------------------------------------------------------------


def export_fields(edition: str = "later") -> list[tuple[str, str]]:
    """(header, field) pairs: 77 in the later edition, 75 in the earlier one."""
    if edition == "later":
        return EXPORT_FIELDS
    return [pair for pair in EXPORT_FIELDS if pair[0] not in LATER_ONLY_HEADERS]
