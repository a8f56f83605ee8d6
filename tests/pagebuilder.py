"""Builds a page in which given paths hold given texts or attributes."""

import html as h
import re


class Node:
    def __init__(self, tag):
        self.tag, self.kids, self.text, self.attrs = tag, [], "", {}

    def child(self, tag, n):
        same = [k for k in self.kids if k.tag == tag]
        while len(same) < n:
            self.kids.append(Node(tag))
            same = [k for k in self.kids if k.tag == tag]
        return same[n - 1]

    def render(self):
        attrs = "".join(f' {k}="{h.escape(v)}"' for k, v in self.attrs.items())
        return f"<{self.tag}{attrs}>{h.escape(self.text)}{''.join(k.render() for k in self.kids)}</{self.tag}>"


class Page:
    def __init__(self):
        self.root = Node("html")
        self.root.child("head", 1)
        self.body = self.root.child("body", 1)
        self.ids = {}

    def at(self, xpath):
        m = re.match(r'//\*\[@id="([^"]+)"\]/?(.*)$', xpath)
        if m:
            if m.group(1) not in self.ids:
                node = Node("aside")
                node.attrs["id"] = m.group(1)
                self.ids[m.group(1)] = node
            node, path = self.ids[m.group(1)], m.group(2)
        else:
            node, path = self.root, xpath.strip("/").removeprefix("html").strip("/")
        for step in [s for s in path.split("/") if s]:
            tag, _, pos = step.partition("[")
            pos = pos.rstrip("]")
            n = int(pos) if pos.isdigit() else 1
            node = node.child(tag, n)
        return node

    def put(self, xpath, text="", **attrs):
        node = self.at(xpath)
        if text:
            node.text = text
        node.attrs.update({k.replace("_", "-"): v for k, v in attrs.items()})
        return self

    def html(self):
        # Elements with an id go behind the rest of the body, which leaves root paths alone.
        self.body.kids += [n for n in self.ids.values() if n not in self.body.kids]
        return "<!DOCTYPE html>" + self.root.render()
