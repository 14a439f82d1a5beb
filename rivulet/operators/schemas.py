"""Schema conversions on the driver: Avro, JSON Schema, Spark types, XSD."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from xml.sax.saxutils import quoteattr

from pyspark.sql import types as T

# Which type stands for which.
AVRO_JSON = {"string": "string", "bytes": "string", "int": "integer", "long": "integer", "float": "number", "double": "number", "boolean": "boolean", "null": "null"}
AVRO_XSD = {"string": "xs:string", "bytes": "xs:base64Binary", "int": "xs:integer", "long": "xs:integer", "float": "xs:decimal", "double": "xs:decimal", "boolean": "xs:boolean"}
JSON_AVRO = {"string": "string", "integer": "long", "number": "double", "boolean": "boolean", "null": "null"}
JSON_SPARK = {"string": T.StringType(), "integer": T.LongType(), "number": T.DoubleType(), "boolean": T.BooleanType()}


def avro_to_json_schema(a) -> dict:
    if isinstance(a, list):
        rest = [x for x in a if x != "null"]
        return avro_to_json_schema(rest[0]) if len(rest) == 1 else {"anyOf": [avro_to_json_schema(x) for x in a]}
    if isinstance(a, str):
        return {"type": AVRO_JSON[a]}
    kind = a["type"]
    if kind == "record":
        optional = lambda f: "default" in f or isinstance(f["type"], list) and "null" in f["type"]
        out = {"type": "object", "properties": {f["name"]: avro_to_json_schema(f["type"]) for f in a["fields"]}}
        required = [f["name"] for f in a["fields"] if not optional(f)]
        return out | ({"title": a["name"]} if "name" in a else {}) | ({"required": required} if required else {})
    if kind == "array":
        return {"type": "array", "items": avro_to_json_schema(a["items"])}
    if kind == "map":
        return {"type": "object", "additionalProperties": avro_to_json_schema(a["values"])}
    if kind == "enum":
        return {"type": "string", "enum": list(a["symbols"])}
    if kind == "fixed":
        return {"type": "string", "minLength": a["size"], "maxLength": a["size"]}
    return avro_to_json_schema(kind)


def json_schema_to_avro(s: dict, name: str = "Record") -> object:
    if "const" in s:
        return {"type": "enum", "name": name, "symbols": [str(s["const"])]}
    if "enum" in s:
        return {"type": "enum", "name": name, "symbols": [str(x) for x in s["enum"]]}
    kind = s.get("type", "string")
    if isinstance(kind, list):
        return [JSON_AVRO[k] for k in sorted(kind, key=lambda k: k != "null")]
    if kind == "array":
        return {"type": "array", "items": json_schema_to_avro(s.get("items", {}), name + "Item")}
    if kind == "object":
        if "properties" not in s:
            return {"type": "map", "values": json_schema_to_avro(s.get("additionalProperties") or {}, name + "Value")}
        fields = []
        for k, v in s["properties"].items():
            t = json_schema_to_avro(v, name + k[:1].upper() + k[1:])
            fields.append({"name": k, "type": t} if k in s.get("required", ()) else {"name": k, "type": ["null", t], "default": None})
        return {"type": "record", "name": s.get("title", name), "fields": fields}
    return JSON_AVRO[kind]


def json_schema_to_spark(s: dict) -> T.DataType:
    """The Spark type for ``from_json``."""
    kind = s.get("type", "string")
    if kind == "object" and "properties" in s:
        return T.StructType([T.StructField(k, json_schema_to_spark(v), k not in s.get("required", ())) for k, v in s["properties"].items()])
    if kind == "object":
        return T.MapType(T.StringType(), json_schema_to_spark(s.get("additionalProperties") or {}))
    if kind == "array":
        return T.ArrayType(json_schema_to_spark(s.get("items", {})))
    return JSON_SPARK.get(kind, T.StringType())


def avro_to_xsd(a: dict) -> str:
    """An XSD with the record as root element."""

    def element(name, t, more="") -> str:
        if isinstance(t, list):
            rest = [x for x in t if x != "null"]
            if len(rest) == 1:
                return element(name, rest[0], more + (' minOccurs="0"' if "null" in t else ""))
            return f"<xs:element name={quoteattr(name)}{more}><xs:complexType><xs:choice>" + "".join(element(f"option{i}", x) for i, x in enumerate(rest)) + "</xs:choice></xs:complexType></xs:element>"
        kind = t if isinstance(t, str) else t["type"]
        if kind == "record":
            inner = "".join(element(f["name"], f["type"]) for f in t["fields"])
            return f"<xs:element name={quoteattr(name)}{more}><xs:complexType><xs:sequence>{inner}</xs:sequence></xs:complexType></xs:element>"
        if kind == "array":
            return element(name, t["items"], ' minOccurs="0" maxOccurs="unbounded"')
        if kind == "enum":
            values = "".join(f"<xs:enumeration value={quoteattr(x)}/>" for x in t["symbols"])
            return f'<xs:element name={quoteattr(name)}{more}><xs:simpleType><xs:restriction base="xs:string">{values}</xs:restriction></xs:simpleType></xs:element>'
        return f'<xs:element name={quoteattr(name)} type="{AVRO_XSD.get(kind, "xs:anyType")}"{more}/>'

    return f'<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">{element(a.get("name", "root"), a)}</xs:schema>'


# Formats of texts, and the types and facets of XSD.
FORMAT_XSD = {"date": "xs:date", "date-time": "xs:dateTime", "time": "xs:time", "uri": "xs:anyURI"}
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
XSD_JSON = {
    "boolean": ("boolean", None), "decimal": ("number", "decimal"), "double": ("number", "double"), "float": ("number", "float"), "dateTime": ("string", "date-time"), "date": ("string", "date"), "time": ("string", "time"),
    "duration": ("string", "duration"), "gYear": ("string", "year"), "gMonth": ("string", "month"), "gDay": ("string", "day"), "gYearMonth": ("string", "year-month"), "gMonthDay": ("string", "month-day"),
    "base64Binary": ("string", "base64"), "hexBinary": ("string", "hex"), "anyURI": ("string", "uri"), "QName": ("string", "qname"), "NOTATION": ("string", "notation"),
    **{t: ("integer", None) for t in ("integer", "nonPositiveInteger", "negativeInteger", "long", "int", "short", "byte", "nonNegativeInteger", "unsignedLong", "unsignedInt", "unsignedShort", "unsignedByte", "positiveInteger")},
}
TEXT_FACETS = {"minLength": "minLength", "maxLength": "maxLength", "pattern": "pattern"}
NUMBER_FACETS = {"minimum": "minInclusive", "maximum": "maxInclusive", "exclusiveMinimum": "minExclusive", "exclusiveMaximum": "maxExclusive"}


def json_schema_to_xsd(schema: dict, name: str = "root") -> str:
    """An XSD whose root element is the schema: objects as sequences, arrays by
    occurrence, facets as restrictions, unions as choices, allOf merged.
    Properties that are not required may be absent, nullable ones nil."""
    def merged(parts: list[dict]) -> dict:
        out: dict = {}
        for p in parts:
            out |= {k: v for k, v in p.items() if k not in ("properties", "required")}
            for k in ("properties", "required"):
                if k in p:
                    out[k] = {**out.get(k, {}), **p[k]} if k == "properties" else [*out.get(k, []), *p[k]]
        return out

    def facets(s: dict, base: str, table: dict) -> str:
        found = [(x, s[k]) for k, x in table.items() if k in s]
        if s.get("format") == "email" and "pattern" not in s:
            found.append(("pattern", EMAIL))
        values = [("enumeration", v) for v in s.get("enum", ())]
        return "".join(f"<xs:{x} value={quoteattr(f'{v:g}' if isinstance(v, float) else str(v))}/>" for x, v in found + values)

    def element(n: str, s: dict, attributes: str = "") -> str:
        open_, close = f"<xs:element name={quoteattr(n)}{attributes}", "</xs:element>"
        if "allOf" in s:
            return element(n, merged([{k: v for k, v in s.items() if k != "allOf"}, *s["allOf"]]), attributes)
        kinds = s.get("anyOf") or s.get("oneOf") or ([{**s, "type": t} for t in s["type"] if t != "null"] if isinstance(s.get("type"), list) else None)
        if kinds:
            some = [k for k in kinds if k.get("type") != "null"]
            if len(some) == 1:
                return element(n, some[0], attributes)
            return f"{open_}><xs:complexType><xs:choice>{''.join(element(f'option{i + 1}', k) for i, k in enumerate(some))}</xs:choice></xs:complexType>{close}"
        if "const" in s:
            s = {"type": "string", "enum": [s["const"]]}
        kind = s.get("type", "string")
        if kind == "object" or "properties" in s:
            return f"{open_}><xs:complexType><xs:sequence>{''.join(child(k, v, s) for k, v in s.get('properties', {}).items())}</xs:sequence></xs:complexType>{close}"
        if kind == "array":
            if not isinstance(s.get("items"), dict):
                raise ValueError(f"array {n!r} needs items")
            least = f' minOccurs="{s["minItems"]}"' if "minItems" in s else "" if "minOccurs" not in attributes else ' minOccurs="0"'
            rest = attributes.replace(' minOccurs="0"', "")
            return element(n, s["items"], f'{rest}{least} maxOccurs="{s.get("maxItems", "unbounded")}"')
        base = {"number": "xs:decimal", "integer": "xs:integer", "boolean": "xs:boolean"}.get(kind, FORMAT_XSD.get(s.get("format"), "xs:string"))
        limits = facets(s, base, NUMBER_FACETS if kind in ("number", "integer") else TEXT_FACETS)
        if limits:
            return f'{open_}><xs:simpleType><xs:restriction base="{base}">{limits}</xs:restriction></xs:simpleType>{close}'
        return f'{open_} type="{base}"/>'

    def child(n: str, s: dict, parent: dict) -> str:
        nullable = isinstance(s.get("type"), list) and "null" in s["type"] or any(k.get("type") == "null" for k in s.get("anyOf", s.get("oneOf", [])))
        return element(n, s, ("" if n in parent.get("required", ()) else ' minOccurs="0"') + (' nillable="true"' if nullable else ""))

    return f'<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">{element(schema.get("title", name), schema)}</xs:schema>'


def xsd_to_json_schema(xsd: str, root: str | None = None) -> dict:
    """The JSON Schema of a root element (the first if none is named): sequences
    and ``all`` as properties, choices as oneOf, occurrence as arrays, attributes
    as ``@name``, extensions merged, named types resolved (a type inside itself
    as any object)."""
    tree = ET.fromstring(xsd)
    local = lambda e: e.tag.rsplit("}", 1)[-1]
    named = {(local(e), e.get("name")): e for e in tree if e.get("name")}
    elements = [e for e in tree if local(e) == "element"]
    if not elements:
        raise ValueError("the XSD has no root element")

    def of_type(name: str, seen: tuple) -> dict:
        short = name.split(":")[-1]
        for kind in ("complexType", "simpleType"):
            if (kind, short) in named:
                if short in seen:
                    return {"type": "object"}
                e = named[kind, short]
                return complex_(e, (*seen, short)) if kind == "complexType" else simple(e, (*seen, short))
        if short in ("anyType", "anySimpleType"):
            return {}
        kind, form = XSD_JSON.get(short, ("string", None))
        return {"type": kind} | ({"format": form} if form else {})

    def simple(e: ET.Element, seen: tuple) -> dict:
        for r in e:
            if local(r) == "restriction":
                inner = next((x for x in r if local(x) == "simpleType"), None)
                out = simple(inner, seen) if inner is not None else of_type(r.get("base", "string"), seen)
                number = out.get("type") in ("number", "integer")
                back = {v: k for k, v in (NUMBER_FACETS if number else TEXT_FACETS).items()}
                for f in r:
                    k, v = local(f), f.get("value")
                    if k == "enumeration":
                        out.setdefault("enum", []).append(v)
                    elif k == "length":
                        out |= {"minLength": int(v), "maxLength": int(v)}
                    elif k == "fractionDigits" and number:
                        out["multipleOf"] = 10.0 ** -int(v) if int(v) else 1
                    elif k in back:
                        out[back[k]] = (int(v) if v.lstrip("+-").isdigit() else float(v)) if number else int(v) if k.endswith("Length") else v
                return out
            if local(r) == "list":
                return {"type": "array", "items": of_type(r.get("itemType", "string"), seen)}
            if local(r) == "union":
                return {"anyOf": [of_type(t, seen) for t in r.get("memberTypes", "").split()] + [simple(x, seen) for x in r]}
        return {"type": "string"}

    def complex_(e: ET.Element, seen: tuple) -> dict:
        out: dict = {"type": "object", "properties": {}}
        required: list[str] = []

        def group(g: ET.Element, must: bool, into: dict):
            for x in g:
                k = local(x)
                if k == "element":
                    n = x.get("name") or x.get("ref", "").split(":")[-1]
                    into[n] = occurs(x, seen)
                    if must and x.get("minOccurs", "1") != "0":
                        required.append(n)
                elif k in ("sequence", "all"):
                    group(x, must and x.get("minOccurs", "1") != "0", into)
                elif k == "choice":
                    options = []
                    for o in x:
                        one: dict = {}
                        if local(o) == "element":
                            n = o.get("name") or o.get("ref", "").split(":")[-1]
                            one[n] = occurs(o, seen)
                        else:
                            group(o, False, one)
                        options.append({"type": "object", "properties": one, "required": [*one]})
                    out.setdefault("oneOf", []).extend(options)
                elif k == "attribute":
                    inner = next((y for y in x if local(y) == "simpleType"), None)
                    into["@" + x.get("name", "")] = simple(inner, seen) if inner is not None else of_type(x.get("type", "string"), seen)
                    if x.get("use") == "required":
                        required.append("@" + x.get("name", ""))
                elif k in ("complexContent", "simpleContent"):
                    for d in x:
                        base = of_type(d.get("base", "string"), seen)
                        if k == "simpleContent":
                            into["#text"] = base
                        else:
                            into |= base.get("properties", {})
                            required.extend(base.get("required", ()))
                        group(d, must, into)

        holder = ET.Element("holder")
        holder.extend(e)
        group(holder, True, out["properties"])
        if not out["properties"]:
            out.pop("properties")
        return out | ({"required": required} if required else {})

    def element(e: ET.Element, seen: tuple) -> dict:
        if e.get("ref"):
            return element(named["element", e.get("ref").split(":")[-1]], seen)
        for x in e:
            if local(x) in ("complexType", "simpleType"):
                return complex_(x, seen) if local(x) == "complexType" else simple(x, seen)
        return of_type(e.get("type", "xs:string"), seen)

    def occurs(e: ET.Element, seen: tuple) -> dict:
        s, most, least = element(e, seen), e.get("maxOccurs", "1"), int(e.get("minOccurs", "1"))
        if e.get("nillable") == "true" and "type" in s:
            s = {**s, "type": [s["type"], "null"]}
        if most == "1":
            return s
        return {"type": "array", "items": s} | ({"minItems": least} if least > 1 else {}) | ({"maxItems": int(most)} if most != "unbounded" else {})

    top = next((e for e in elements if e.get("name") == root), None) if root else elements[0]
    if top is None:
        raise ValueError(f"no element {root!r}")
    return {"title": top.get("name")} | element(top, ())


def xsd_to_avro(xsd: str, root: str | None = None, optional: str = "nullable") -> object:
    """The Avro schema of a root element, by way of JSON Schema.  Fields that may
    be absent are unions with null (``nullable``), their own type (``strict``),
    or all fields are unions (``permissive``)."""
    if optional not in ("nullable", "strict", "permissive"):
        raise ValueError("optional is nullable, strict or permissive")

    def fixed(a):
        if isinstance(a, dict) and a.get("type") == "record":
            fields = []
            for f in a["fields"]:
                t = f["type"]
                some = isinstance(t, list) and t[0] == "null"
                inner = fixed(t[1] if some else t)
                wrap = some and optional != "strict" or optional == "permissive"
                fields.append({"name": f["name"].lstrip("@#"), "type": ["null", inner], "default": None} if wrap else {"name": f["name"].lstrip("@#"), "type": inner})
            return {**a, "fields": fields}
        if isinstance(a, dict) and "items" in a:
            return {**a, "items": fixed(a["items"])}
        return a

    def plain(s: dict) -> dict:
        """Choices as optional properties, nullable types as their own."""
        s = dict(s)
        if "oneOf" in s:
            s["properties"] = s.get("properties", {}) | {k: v for o in s.pop("oneOf") for k, v in o["properties"].items()}
        if "properties" in s:
            s["properties"] = {k: plain(v) for k, v in s["properties"].items()}
        if isinstance(s.get("items"), dict):
            s["items"] = plain(s["items"])
        if "anyOf" in s:
            s = {"type": "string"}
        if isinstance(s.get("type"), list):
            s["type"] = next(t for t in s["type"] if t != "null")
        return s

    s = plain(xsd_to_json_schema(xsd, root))
    return fixed(json_schema_to_avro(s, s.get("title", "Record")))
