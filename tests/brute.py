"""A plain recursive reading of the shredding rules, for comparison on small inputs."""

import xml.etree.ElementTree as ET


def shred(xml: str, uid: str, mapping) -> dict[str, list[dict]]:
    out: dict[str, list[dict]] = {}
    open_rows: list[dict] = []

    def put(table, column, value):
        for row in open_rows:  # the outermost open row of that table
            if row["#table"] == table:
                row[column] = value
                return

    def visit(node, path, at):
        name = node.tag.rsplit("}", 1)[-1]  # without its name space
        return walk(node, f"{path}/{name}", at.children.get(name) if at is not None else None)

    def walk(node, path, element):
        opened = None
        if element is not None and element.table:
            parent = open_rows[-1] if open_rows else None
            if parent is None:
                opened = {"#table": element.table, "#keys": {"id": uid}}
            else:
                slot = "#ctr " + element.counter  # a parent row counts its children per counter name
                parent[slot] = parent.get(slot, 0) + 1
                opened = {"#table": element.table, "#keys": {**parent["#keys"], element.counter: parent[slot]}}
            opened.update(opened["#keys"])
            open_rows.append(opened)
        if element is not None:
            for name, target in element.attrs.items():
                if name in node.attrib:
                    put(target.table, target.column, node.attrib[name])
                elif target.default is not None:
                    put(target.table, target.column, target.default)
            if element.text and node.text:
                put(element.text.table, element.text.column, node.text)
        for child in node:
            visit(child, path, element)
        if opened is not None:
            open_rows.remove(opened)
            out.setdefault(opened["#table"], []).append({k: v for k, v in opened.items() if not k.startswith("#")})

    walk(ET.fromstring(xml), mapping.record.path, mapping.record)
    return out
