"""Fixed values of the rules that label historical cases when they are indexed."""

from __future__ import annotations

from deskloom.functions.rules import Rule, RuleSet

# --- fixed values: phrases in order of precedence ------------------------------------------------

PHRASES = [
    ("I10", [
        "fraud", "fraudulent", "unauthorized", "unauthorised", "identity theft",
        "stolen identity", "someone opened", "didn't open", "did not open", "not me",
        "wasn't me", "wasnt me", "account hacked", "hack my account",
    ]),
    ("I07", [
        "bill", "billing", "charged", "charge", "payment", "paid", "paying", "overcharge",
        "overcharged", "refund", "price", "pricing", "fee", "fees", "cost",
    ]),
    ("I08", [
        "install", "installation", "installer", "technician", "appointment", "schedule",
        "scheduled", "no show", "no-show", "service visit",
    ]),
    ("I09", ["voicemail", "voice mail", "landline", "home phone", "dial tone", "phone line"]),
    ("I06", [
        "fios app", "my fios", "fios mobile app", "login", "log in", "logged in", "password",
        "authentication", "authenticate", "sign in", "access account", "can't access",
        "cannot access",
    ]),
    ("I04", [
        "tv", "television", "channel", "channels", "dvr", "on demand", "hbo", "showtime",
        "univision", "sports", "cable",
    ]),
    ("I05", [
        "mobile", "cell phone", "cellular", "wireless", "4g", "5g", "lte", "text messages", "sms",
    ]),
    ("I01", [
        "internet is down", "internet down", "no internet", "internet outage", "outage",
        "service outage", "connection is down", "connection down", "not working",
        "isn't working", "isnt working",
    ]),
    ("I02", [
        "slow", "slower", "slow speed", "slow speeds", "speed", "buffer", "buffering", "lag",
        "latency", "packet loss", "disconnect", "disconnecting", "drops", "dropped",
        "unstable", "upload", "download", "ping",
    ]),
    ("I03", [
        "router", "modem", "ont", "equipment", "gateway", "reboot", "reset router",
        "reset modem", "red light", "lan light", "wifi router",
    ]),
    ("I11", [
        "customer service", "terrible service", "horrible service", "bad service",
        "ridiculous", "unacceptable", "complaint", "manager", "agent", "representative",
        "support", "waiting", "cancel", "cancellation",
    ]),
]

#: The text is cleaned as for the index, so phrases with an apostrophe or a hyphen never occur.
INDEX_RULES = RuleSet(
    name="index",
    rules=tuple(Rule(label, any_of=phrases) for label, phrases in PHRASES),
    default="I12",
    profile="index",
)
